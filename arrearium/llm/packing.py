"""Mixture-controlled packing of documents into sequences of fixed length."""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, slices
from arrearium.session import stored

#: Words whose ids a Python worker keeps; further ones are encoded whenever they occur. Bounds memory, changes no result.
WORDS_KEPT = 500_000

# White space other than the blank; next to a blank it keeps the blank from being the start of a word of its own.
_ODD_SPACE = "".join(map(chr, [*range(9, 14), *range(28, 32), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
# Fixed value: how byte-level pre-tokenizers split text.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PROBES = ["Hello  world's 12\n\n x\t!", " été straße 你好 \U0001f600", "", "a b  \n c\r\n", "x1y22 _-_ ...  "]
_TOKENIZERS: dict = {}


def _plain_words(text: str) -> bool:
    """Whether every blank stands between two visible characters: cutting there never cuts a pre-token."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return not any(c in text and (" " + c in text or c + " " in text) for c in _ODD_SPACE)


class _Encoder:
    """Ids by a tokenizer file, in a Python worker.

    A byte-level file whose ids are the order of its merges is run by the faster merge loop of tiktoken, if that agrees on
    the probes; texts that hold a special token, and all other files, are run by the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.known: dict[str, bytes] = {}
        self.merges = None
        kind = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") == "BPE" and kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space") and not spec.get("normalizer"):
            self.merges = self._merges(spec["model"]["vocab"])
            if self.merges and any(self.merges.encode_ordinary(x) != self.tokenizer.encode(x, add_special_tokens=False).ids for x in _PROBES):
                self.merges = None

    def _merges(self, vocab: dict[str, int]):
        import tiktoken

        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        if sorted(ranks.values()) != list(range(len(ranks))):
            return None
        return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == '<u2' else 'I'}", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian bytes, the closing 0 included."""
        end = self._bytes([0])
        out: list[bytes | None] = [None] * len(texts)
        split: dict[int, list[str]] = {}
        for i, t in enumerate(texts):
            if not t:
                out[i] = end
            elif self.merges is None or any(x in t for x in self.special):
                out[i] = self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids) + end
            elif _plain_words(t):
                split[i] = t.split(" ")
            else:
                out[i] = self._bytes(self.merges.encode_ordinary(t)) + end
        # The first word has no blank before it; all others are kept with theirs.
        words: set[str] = set()
        for parts in split.values():
            words.update(parts[1:])
        new = words.difference(self.known)
        run, known = self.merges and self.merges.encode_ordinary, self.known
        for w in new:
            known[w] = self._bytes(run(" " + w))
        for i, parts in split.items():
            first = self._bytes(run(parts[0]))
            out[i] = first + b"".join(map(known.__getitem__, parts[1:])) + end
        if len(known) > WORDS_KEPT:
            for w in new:
                del known[w]
        return out


def _encoder(path: str) -> _Encoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _Encoder(path)
    return _TOKENIZERS[path]


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """Row number, id, source, n (ids with the closing 0) and the ids as little-endian bytes, written once.

    Null text is empty: its only id is the closing 0. The path must be readable on every executor.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        width = encoder.width
        for b in slices(batches, "text"):
            ids = encoder.encode(b.column("text").to_pylist())
            n = [len(x) // np.dtype(width).itemsize for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("source"), pa.array(n, pa.int64()), pa.array([int(width[2])] * len(n), pa.int32()),
                 pa.array(ids, pa.binary())], ["id", "source", "n", "width", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, source string, n long, width int, ids binary")
    return stored(out.select(F.monotonically_increasing_id().alias(ROW), "*"), "tokens")


def _positions(rows: DataFrame, group: list[str], lot: Column, order: list[str | Column], length: str, out: str) -> DataFrame:
    """Sum of length over the rows before this one in (lot, order) within the group; no group has to fit a task.

    Lots are ordered slices of the group; only the totals by lot are summed in one window.
    """
    at = rows.withColumn("_lot", lot)
    lots = at.groupBy(*group, "_lot").agg(F.sum(length).alias("_t"))
    before = W.partitionBy(*group).orderBy("_lot").rowsBetween(W.unboundedPreceding, -1)
    lots = lots.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_lot").alias("_lot2"),
                       F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    within = W.partitionBy(*group, "_lot").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = at.withColumn("_w", F.coalesce(F.sum(length).over(within), F.lit(0)))
    same = F.col("_lot") == F.col("_lot2")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return summed.join(lots, same).select(*rows.columns, (F.col("_w") + F.col("_o")).alias(out))


def schedule(tokens: DataFrame, mix: dict[str, float] | None = None, window_tokens: int = 65_536,
             packet_tokens: int = 1_024, lot_rows: int = 5_000, most_lots: int = 4_096) -> DataFrame:
    """Deficit round-robin over one queue per source: packets (row, start, length) with their place in the stream.

    Each round is one window of window_tokens. A queue gets its share of them as credit and sends packets (whole
    documents, long ones cut at packet_tokens) while credit lasts; what is left, less than one packet, is its
    deficit and carries over. A packet that ends at token E of its queue is therefore sent in round
    ceil(E / credit): no step waits for the one before, whatever task or partition holds the packet. A queue that
    has run out gets no credit, and the others go on.

    mix: target share by source ('' for null); sources not named share what is left of 1, or get the least named
    share if nothing is. None: shares as in the corpus, so that all queues end together. Queue order is by hash.
    """
    per_source = tokens.groupBy("source").agg(F.sum("n").alias("_n"), F.count("*").alias("_rows"))
    if mix is None:
        share = F.col("_n") / F.lit(tokens.agg(F.sum("n")).first()[0] or 1)
    else:
        named = F.create_map(*[F.lit(x) for s, p in mix.items() for x in (s, float(p))])
        rest = max(0.0, 1.0 - sum(mix.values()))
        key = F.coalesce("source", F.lit(""))
        others = F.lit(max(1, per_source.where(F.element_at(named, key).isNull()).count()))
        share = F.coalesce(F.element_at(named, key), F.lit(rest) / others if rest else F.lit(min(mix.values())))
    queues = per_source.select(
        F.col("source").alias("_source"), (share * window_tokens).alias("_credit"),
        F.least(F.lit(most_lots), F.ceil(F.col("_rows") / lot_rows)).cast("int").alias("_lots"))
    at = tokens.select(ROW, "source", "n", F.xxhash64("id", ROW).alias("_h")).join(
        queues, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # The hash as a share of its range, cut into lots of equal width: lots are in hash order.
    lot = F.floor((F.col("_h").cast("double") / 2.0**64 + 0.5) * F.col("_lots")).cast("int")
    at = _positions(at, ["source"], lot, ["_h", ROW], "n", "_at")
    cut = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / packet_tokens))).alias("_k")
    packets = at.select(ROW, "source", "n", "_at", "_credit", cut).select(
        ROW, "source", (F.col("_k") * packet_tokens).alias("start"),
        F.least(F.lit(packet_tokens), F.col("n") - F.col("_k") * packet_tokens).alias("length"), "_at", "_credit")
    packets = packets.withColumn("_round", F.ceil((F.col("_at") + F.col("start") + F.col("length")) / F.col("_credit")))
    packets = stored(packets.select(ROW, "source", "start", "length", (F.col("_at") + F.col("start")).alias("_queue"), "_round"), "packets")
    rounds = packets.agg(F.max("_round").alias("r")).first()["r"] or 1
    per_lot = max(1, -(-rounds // most_lots), lot_rows * packet_tokens // (4 * window_tokens))
    one = packets.withColumn("_all", F.lit(0))
    return _positions(one, ["_all"], F.floor(F.col("_round") / per_lot), ["_round", "source", "_queue", ROW], "length", "place").select(
        ROW, "source", "start", "length", "_round", "place")


def cut(packets: DataFrame, sequence_tokens: int = 1_024) -> DataFrame:
    """Cut the stream every sequence_tokens: one row for each piece, with the sequence and the offset there."""
    first, last = F.floor(F.col("place") / sequence_tokens), F.floor((F.col("place") + F.col("length") - 1) / sequence_tokens)
    p = packets.select(ROW, "start", "length", "place", F.explode(F.sequence(first, last)).alias("sequence_id"))
    begin = F.greatest(F.col("place"), F.col("sequence_id") * sequence_tokens)
    end = F.least(F.col("place") + F.col("length"), (F.col("sequence_id") + 1) * sequence_tokens)
    return p.select(ROW, (F.col("start") + begin - F.col("place")).alias("start"), (end - begin).alias("length"), "sequence_id",
                    (begin - F.col("sequence_id") * sequence_tokens).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, mix: dict[str, float] | None = None, sequence_tokens: int = 1_024,
         window_tokens: int = 65_536, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         with_ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of sequence_tokens; each id lies in exactly one piece.

    Returns a row for each piece: the id column, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless
    with_ids=False, ids (array of int). Only the last sequence can be short. Null and empty texts are one piece of the
    closing id; repeated rows are packed as often as they occur; a null source is a queue of its own; no documents, no
    pieces. Other columns of docs are not read, whatever their names.
    """
    tokens = tokenize(docs, tokenizer_path, id_col, text_col, source_col)
    pieces = cut(schedule(tokens, mix, window_tokens, sequence_tokens), sequence_tokens)
    # A document's own pieces: as many as its length asks for, whatever the corpus.
    by_row = pieces.groupBy(ROW).agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ids", 1_000_000):
            cols: dict[str, list] = {k: [] for k in ("at", "start", "length", "crc", "n", "sequence_id", "offset", "ids")}
            for i, (ids, n, width, pieces) in enumerate(zip(*[b.column(c).to_pylist() for c in ("ids", "n", "width", "pieces")])):
                wide = np.frombuffer(ids, dtype=f"<u{width}").astype("<u4")
                for p in pieces:
                    part = wide[p["start"]:p["start"] + p["length"]]
                    for k, v in (("at", i), ("start", p["start"]), ("length", p["length"]), ("crc", zlib.crc32(part.tobytes())),
                                 ("n", n), ("sequence_id", p["sequence_id"]), ("offset", p["offset"])):
                        cols[k].append(v)
                    if with_ids:
                        cols["ids"].append(part.astype(np.int32))
            out = [b.column("id").take(pa.array(cols["at"], pa.int64())),
                   *[pa.array(cols[k], pa.int64()) for k in ("start", "length", "crc", "n", "sequence_id", "offset")]]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                out.append(pa.array(cols["ids"], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = (f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)
    return tokens.join(by_row, ROW).select("id", "n", "width", "ids", "pieces").mapInArrow(run, schema)
