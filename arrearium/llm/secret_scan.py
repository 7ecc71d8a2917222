"""Secret scans: patterns, and ownership frequency over the whole corpus. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, sent, text_key
from arrearium.session import scratch_scope, stored

# Kinds of base spans in the order in which they are listed, with their patterns.
KINDS = ["assign", "access", "hex"]
_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ASSIGN_LEAST = 12
# A run of such characters is always taken whole, so a least length in the pattern drops what a later filter would.
_ACCESS = r"AKIA[A-Z0-9]{14,}"
_HEX = r"[0-9a-f]{16,}"
_KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

# A candidate of no known form: a long run of key characters with digits, and letters of both cases.
_CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

_SPAN = "array<struct<start: long, end: long, text: string>>"


def spans_of(text: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive) and text of every match, left to right, without overlap.

    The pieces between matches, as split gives them, and the matches' own lengths add up to the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["match"].alias("text")))).alias("spans"))

    pairs = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    spans = F.aggregate(pairs, zero, step)["spans"]
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(_SPAN))


def _assign(text: Column) -> Column:
    lower = F.lower(text)
    may = F.lit(False)
    for word in _KEYWORDS:
        may = may | F.contains(lower, F.lit(word))
    long_enough = F.filter(spans_of(text, _ASSIGN), lambda s: F.length(F.regexp_extract(s["text"], _ASSIGN, 2)) >= _ASSIGN_LEAST)
    return F.when(may, long_enough).otherwise(F.array().cast(_SPAN))


def _kind(spans: Column, k: int, name: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end"),
                                                 F.lit(name).alias("kind"), F.xxhash64(s["text"]).alias("hash")))


def candidates(docs: DataFrame, text_col: str) -> DataFrame:
    """docs plus base (spans by pattern) and other (candidates of no known form that touch no base span)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    parts = [_kind(s, k, n) for k, (n, s) in enumerate((
        ("assign", _assign(text)),
        ("access", F.when(F.contains(text, F.lit("AKIA")), spans_of(text, _ACCESS)).otherwise(F.array().cast(_SPAN))),
        ("hex", spans_of(text, _HEX))))]
    found = docs.withColumn("base", F.array_sort(F.concat(*parts)))
    mixed = F.filter(spans_of(text, _CANDIDATE), lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Z]") & s["text"].rlike("[a-z]"))
    apart = F.filter(_kind(mixed, len(KINDS), "owned"), lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.withColumn("other", apart)


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories: in how many distinct ones each candidate occurs, over the whole corpus.

    Pairs are made distinct first, with partial results in each task, so a string that a third of all documents copy
    is one row for each owner before it is counted. Nulls count as no owner and no repository.
    """
    def counted(column: str, out: str) -> DataFrame:
        return found.where(F.col(column).isNotNull()).select("hash", column).distinct().groupBy("hash").agg(F.count("*").alias(out))

    return counted("owner", "owners").join(counted("repository", "repositories"), "hash", "full").select(
        "hash", F.coalesce("owners", F.lit(0)).alias("owners"), F.coalesce("repositories", F.lit(0)).alias("repositories"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None,
         most_owners: int = 1, most_repositories: int | None = None) -> DataFrame:
    """A row for each document: id, row number and spans: structs (start, end, kind, verdict, owners, repositories).

    Spans of the known patterns are always reported. Their verdict is 'live' where the string belongs to at most
    most_owners owners, else 'example': a string that many share is documentation. In how many of its owners' repositories
    it stands does not matter, as copies and reused keys are live too; only most_repositories, if given, sets a limit.
    A string of no known form is added, as kind 'owned', only where it is live in that sense and not null-owned.
    Without a repository column each document is a repository of its own. Null text is empty; repeated rows are one
    repository; empty tables give empty results; other columns are not read.
    """
    repository = F.col(f"`{repository_col or id_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{owner_col}`").cast("string").alias("owner"),
                       repository.alias("repository"), F.col(f"`{text_col}`").alias("text"))
    seen = candidates(rows, "text").select(F.monotonically_increasing_id().alias(ROW), "id", "owner", "repository", F.concat("base", "other").alias("c"))
    seen = stored(seen, "candidates")
    each = stored(seen.where("size(c) > 0").select(ROW, "owner", "repository", F.explode("c").alias("s")).select(ROW, "owner", "repository", "s.*"), "found")
    known = each.join(stored(ownership(each), "owners"), "hash", "left").select(
        ROW, "start", "rank", "end", "kind", F.coalesce("owners", F.lit(0)).alias("owners"), F.coalesce("repositories", F.lit(0)).alias("repositories"))
    live = F.col("owners").between(1, most_owners)
    if most_repositories is not None:
        live = live & (F.col("repositories") <= most_repositories)
    judged = known.withColumn("verdict", F.when(live, "live").otherwise("example")).where((F.col("kind") != "owned") | live)
    # One document's spans: as many as its text holds.
    lists = judged.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct(
        "start", "rank", "end", "kind", "verdict", "owners", "repositories"))).alias("spans"))
    return seen.select(ROW, F.col("id").alias(id_col)).join(lists, ROW, "left").withColumn(
        "spans", F.when(F.col("spans").isNull(), F.array().cast(lists.schema["spans"].dataType)).otherwise(F.col("spans")))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", mark: str = "[SECRET]",
           length_col: str | None = "n_chars") -> DataFrame:
    """docs with every reported span replaced by the mark; overlapping spans become one mark; columns as they came.

    What a text holds and the whole corpus decide, so rows are told by the key of their text: docs is read again and
    never copied. Texts without spans, nulls included, stay as they are; length_col, if docs has it, is the length of changed texts.
    """
    key = text_key(F.col(f"`{text_col}`"))
    told = docs.select(F.struct(*key).alias("key"), F.col(f"`{id_col}`").alias("repository"), F.col(f"`{owner_col}`").alias("owner"),
                       F.col(f"`{text_col}`").alias("text"))
    with scratch_scope(docs.sparkSession):
        found = scan(told, "key", "text", "owner", "repository").where("size(spans) > 0")
        spans = stored(found.groupBy("key").agg(F.first("spans").alias("_spans")).select("key.*", "_spans"), "spans", keep=True)
    text, out = F.col(f"`c_{text_col}`"), F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        fresh = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, F.concat(state["done"], between, F.lit(mark))).otherwise(
            state["done"]).alias("done"))

    rows = docs.select(*key, *[F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns]).join(sent(spans, 100_000), ["_k1", "_k2"], "left")
    done = rows.withColumn("_s", F.when(F.col("_spans").isNotNull(), F.aggregate("_spans", out, step)))
    done = done.withColumn("_new", F.concat(F.col("_s.done"), F.substring(text, (F.col("_s.at") + 1).cast("int"), F.lit(1 << 30))))
    columns = {c: F.col(f"`c_{c}`") for c in docs.columns}
    columns[text_col] = F.coalesce("_new", text)
    if length_col in docs.columns:
        columns[length_col] = F.coalesce(F.length("_new").cast(docs.schema[length_col].dataType), columns[length_col])
    return done.select(*[v.alias(c) for c, v in columns.items()])
