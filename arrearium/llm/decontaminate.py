"""Benchmark decontamination on a distributed positional inverted index. DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import ROW, sent, text_key
from arrearium.session import scratch_scope, stored

# Words are made of these characters, once A-Z are lower-cased; all other ASCII separates them.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Benchmark terms up to this number are sent to every executor; beyond it the index build shuffles words.
TERMS_SENT = 500_000


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, _BETWEEN), lambda w: w != "")


@dataclass
class Index:
    """postings: row, id, term, pos - one for each occurrence of a term, in the order of the documents. Term -1 is the
    end of a document: its pos is the number of words. terms: term, word, freq (occurrences in all documents)."""

    postings: DataFrame
    terms: DataFrame
    items: DataFrame
    windows: DataFrame
    items_words: DataFrame


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> Index:
    """Store the positional postings of all words that any benchmark item holds: no other word can be part of a match.

    One pass over the texts and no shuffle: postings are written where they are made, in document order, so ids and
    positions compress well. Windows are the runs of `window` words of an item, a shorter item being one window; each
    keeps its terms from the rarest in the training texts to the commonest, with their offsets.
    """
    item_words = stored(benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("w")).where("size(w) > 0"), "items")
    distinct = stored(item_words.select(F.explode("w").alias("word")).distinct().select(
        F.monotonically_increasing_id().alias("term"), "word"), "terms")
    end = docs.sparkSession.range(1).select(F.lit(-1).cast("long").alias("term"), F.lit("").alias("word"))
    end = stored(end.unionByName(distinct), "terms-and-end")
    # Numbered before the words are told apart: a number is a document's.
    texts = docs.select(F.monotonically_increasing_id().alias(ROW), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    tokens = texts.select(ROW, "id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit("")))).alias("pos", "word"))
    postings = stored(tokens.join(sent(end, TERMS_SENT), "word").select(ROW, "id", "term", "pos"), "postings")
    freq = postings.groupBy("term").agg(F.count("*").alias("freq"))
    terms = stored(distinct.join(freq, "term", "left").select("term", "word", F.coalesce("freq", F.lit(0)).alias("freq")), "frequencies")

    last = F.greatest(F.size("w") - window, F.lit(0))
    windows = item_words.select("item", F.explode(F.sequence(F.lit(0), last)).alias("at"), "w").select(
        F.slice("w", F.col("at") + 1, window).alias("w")).distinct().select(F.xxhash64("w").alias("win"), "w")
    per_term = windows.select("win", F.posexplode("w").alias("off", "word")).join(terms, "word")
    windows = stored(per_term.groupBy("win").agg(F.array_sort(F.collect_list(F.struct("freq", "term", "off"))).alias("t")), "windows")
    of_items = item_words.select("item", F.explode(F.sequence(F.lit(0), last)).alias("at"), "w").select(
        "item", F.xxhash64(F.slice("w", F.col("at") + 1, window)).alias("win")).distinct()
    return Index(postings, terms, stored(of_items, "windows-of-items"), windows, item_words)


def phrase_matches(index: Index) -> DataFrame:
    """Every exact occurrence of a window: row, win, start, length.

    Lists are intersected from the rarest term on, each shifted by the term's offset. The first two lists are joined on
    row and position, and hold few postings; what they leave, is nearly all true, so the remaining terms are looked up
    by (row, term, position), each place once however many windows ask for it. What is found grows with the corpus, so
    that join shuffles the index at every size; only the benchmark's own terms and windows are sent to all executors.
    """
    absent = F.col("t")[0]["freq"] == 0
    windows = index.windows.where(~absent).select("win", "t", F.size("t").alias("n"))
    windows = sent(stored(windows, "present"), TERMS_SENT)
    t = F.col("t")
    first = index.postings.join(windows.select("win", "n", t[0]["term"].alias("term"), t[0]["off"].alias("off"),
                                               F.try_element_at(t, F.lit(2)).alias("next")), "term")
    begun = first.select(ROW, "win", "n", (F.col("pos") - F.col("off")).alias("start"), "next").where("start >= 0")
    # Postings of the terms that are second in some window.
    seconds = sent(stored(windows.where("n > 1").select(t[1]["term"].alias("term")).distinct(), "seconds"), TERMS_SENT)
    second = index.postings.join(seconds, "term", "left_semi").select(
        F.col(ROW).alias("_r"), F.col("term").alias("_t"), F.col("pos").alias("_p"))
    probe = begun.where("n > 1").withColumns({"_t2": F.col("next.term"), "_p2": F.col("start") + F.col("next.off")})
    pairs = probe.join(second, (F.col(ROW) == F.col("_r")) & (F.col("_t2") == F.col("_t")) & (F.col("_p2") == F.col("_p"))).select(
        ROW, "win", "n", "start")
    held = stored(pairs.unionByName(begun.where("n = 1").select(ROW, "win", "n", "start")), "begun")

    rest = held.join(windows.select("win", "t"), "win").where("n > 2").select(
        ROW, "win", "start", "n", F.explode(F.slice("t", 3, 1 << 20)).alias("x")).select(
        ROW, "win", "start", "n", F.col("x.term").alias("term"), (F.col("start") + F.col("x.off")).alias("pos"))
    places = stored(rest.select(ROW, "term", "pos").distinct(), "places")
    real = index.postings.select(ROW, "term", "pos").join(places.hint("merge"), [ROW, "term", "pos"], "left_semi").distinct()
    whole = rest.join(real, [ROW, "term", "pos"]).groupBy(ROW, "win", "start", "n").agg(F.count("*").alias("c")).where("c = n - 2")
    return held.where("n <= 2").select(ROW, "win", "start", F.col("n").alias("length")).unionByName(
        whole.select(ROW, "win", "start", F.col("n").alias("length"))).distinct()


def proximity_matches(index: Index, terms: list[str], within: int) -> DataFrame:
    """Places where all terms (distinct words) lie within a span of that many words: row, start, end (inclusive).

    The index holds no words but the benchmark's: any other term is an error, as the training texts may hold it.
    """
    if within < 1 or not terms:
        raise ValueError("at least one term and a span of at least one word are needed")
    wanted = index.terms.where(F.col("word").isin(terms)).orderBy("freq", "term").collect()
    unknown = sorted(set(terms) - {w["word"] for w in wanted})
    if unknown:
        raise ValueError(f"not indexed, as no benchmark item holds them: {unknown}")
    asked = index.terms.sparkSession.range(1).select(
        F.lit(0).alias("query"), F.array(*[F.lit(w["term"]).cast("long") for w in wanted]).alias("terms"))
    return proximity(index, asked, len(wanted), within).select(ROW, "start", "end")


def proximity(index: Index, asked: DataFrame, number: int, within: int) -> DataFrame:
    """query, row, start, end (inclusive): places where all terms of a query lie within a span of that many words.

    asked: a stored table (query, terms: `number` different term ids, rarest first). One row is returned for each occurrence of
    the rarest term that is part of such a span: the narrowest span that holds
    it, of equal ones the first. A span's left end is the rarest term's own place or a posting before it; given the left
    end, each other list takes its first posting from there on. So each list, rarest first, is looked up around the
    candidates (fewer than `within` places on either side), and those that lack a term drop out before the next list.
    """
    def postings(k: int, place: str) -> DataFrame:
        return index.postings.join(sent(asked.select("query", F.col("terms")[k].alias("term"))), "term").select("query", ROW, F.col("pos").alias(place))

    base, lists = postings(0, "p"), []
    for k in range(1, number):
        # A posting is near only if it lies in the same or a neighbouring stretch of `within` words.
        other = postings(k, "q").select("query", ROW, "q", F.explode(F.array(*[F.floor(F.col("q") / within) + d for d in (-1, 0, 1)])).alias("_s"))
        met = base.withColumn("_s", F.floor(F.col("p") / within)).join(other, ["query", ROW, "_s"]).where(F.abs(F.col("p") - F.col("q")) < within)
        # At most 2 * within - 1 places, as a place holds one word.
        base = met.groupBy("query", ROW, "p", *lists).agg(F.array_sort(F.collect_set("q")).alias(f"q{k}"))
        lists.append(f"q{k}")

    def span(start: Column) -> Column:
        """The span from start on that reaches p and one posting of each list; no end if a list has none."""
        ends = [F.array_min(F.filter(F.col(q), lambda x: x >= start)) for q in lists]
        has_all = F.lit(True)
        for e in ends:
            has_all = has_all & e.isNotNull()
        end = F.greatest(F.col("p"), *ends) if ends else F.col("p")
        return F.struct((end - start).alias("d"), start.alias("start"), F.when(has_all, end).alias("end"))

    starts = F.filter(F.concat(F.array("p"), *lists), lambda x: x <= F.col("p"))
    spans = F.filter(F.transform(starts, span), lambda s: s["end"].isNotNull() & (s["d"] < within))
    return base.withColumn("_m", F.array_min(spans)).where("_m is not null").select("query", ROW, "p", "_m.start", "_m.end")


def item_proximity(docs: DataFrame, benchmark: DataFrame, number: int = 3, within: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, the document's id, place, start, end: where the `number` rarest words of an item lie within a span of `within` words.

    A paraphrase or a shuffled copy of an item is found by it, where no window of the item occurs. A row for each occurrence
    (place) of an item's rarest word in such a span, with the narrowest span. Words are ranked by how often they occur in docs, equal
    ones by the word. Items of fewer different words are left out, null texts have none; rows that repeat an item give the same
    places. An item with a word that no document holds has no place. Other columns are not read.
    """
    index = build_index(docs, benchmark, 1, id_col, text_col, item_col, item_text_col)
    held = index.items_words.select("item", F.explode(F.array_distinct("w")).alias("word")).distinct().join(index.terms, "word")
    ranked = held.groupBy("item").agg(F.array_sort(F.collect_set(F.struct("freq", "word", "term"))).alias("t"))  # an item's own words
    ranked = ranked.where(F.size("t") >= number).select(F.col("item").alias("query"), F.transform(F.slice("t", 1, number), lambda t: t["term"]).alias("terms"))
    found = proximity(index, stored(ranked, "asked"), number, within)
    ids = index.postings.where("term = -1").select(ROW, "id")
    return found.join(ids, ROW).select(F.col("query").alias(item_col), F.col("id").alias(id_col), F.col("p").alias("place"), "start", "end")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id, n_words, n_hit, n_items, items_sha256, contaminated, and the row number.

    A word is hit if it lies in an occurrence of any window. Null and empty texts have no words and are never hit; items
    without words match nothing; repeated items count by their id once; repeated rows are judged each. With an empty
    benchmark nothing is hit. Other columns are not read, whatever their names.
    """
    index = build_index(docs, benchmark, window, id_col, text_col)
    with scratch_scope(docs.sparkSession):
        found = stored(phrase_matches(index), "matches", keep=True)
    hit = found.select(ROW, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    hit = hit.groupBy(ROW).agg(F.count("*").alias("n_hit"))
    # At most one row for each item and document; the list is as long as the benchmark at most.
    items = found.select(ROW, "win").distinct().join(index.items, "win").select(ROW, "item").distinct()
    items = items.groupBy(ROW).agg(F.count("*").alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("list"))
    ends = index.postings.where("term = -1").select(ROW, F.col("id").alias(id_col), F.col("pos").cast("long").alias("n_words"))
    judged = hit.join(items, ROW)
    return ends.join(judged, ROW, "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("list", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), ROW)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that hold an occurrence of a window; columns as they came.

    Texts alone decide, so rows are told by the key of their text: docs is read again and never copied.
    """
    key = text_key(F.col(f"`{text_col}`"))
    with scratch_scope(docs.sparkSession):
        found = contamination(docs.select(F.struct(*key).alias("key"), F.col(f"`{text_col}`").alias("text")), benchmark, window, "key", "text")
        gone = stored(found.where("contaminated").select("key.*").distinct(), "contaminated", keep=True)
    rows = docs.select(*key, *[F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns])
    return rows.join(sent(gone), ["_k1", "_k2"], "left_anti").select(*[F.col(f"`c_{c}`").alias(c) for c in docs.columns])
