"""Benchmark decontamination: a positional inverted index, searched from the rarest terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import WORD_BREAK, ascii_lower
from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

WINDOW = 10
END = "\x00"  # no word; stands behind the last word of every document


def words(text: Column) -> Column:
    """Lower-cased words of a text (only A-Z are lowered); null and wordless texts have none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), lambda w: w != "")


@dataclass(frozen=True)
class Index:
    """Postings (term_id, id, copy, pos) and the terms they are of.

    `id` and `copy` (a hash of the text) name a document together, so that
    rows which repeat an id with another text stay apart. Term 0 is the end
    mark: its position is the number of words.
    """

    terms: DataFrame
    postings: DataFrame
    counts: DataFrame


def build_index(docs: DataFrame, key: str, text: str, terms: DataFrame) -> Index:
    """Positional postings of `terms` (distinct `term`) in all of `docs`, stored in the shared folder.

    One pass over the texts with no shuffle: postings stay in document order,
    in columns that compress to a few bytes each. `terms` is broadcast only if
    its measured size allows.
    """
    numbered = terms.filter("term is not null").distinct()
    numbered = numbered.select("term", F.row_number().over(Window.orderBy("term")).alias("term_id"))
    numbered = numbered.union(numbered.sparkSession.createDataFrame([(END, 0)], "term string, term_id int"))
    numbered = materialize(numbered, "terms")
    split = F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK)
    rows = docs.select(
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("copy"), F.array_append(split, F.lit(END)).alias("words")
    )
    # A text that begins (or ends) with a break has an empty first (or last) entry.
    lead = F.when(F.col("words")[0] == "", 1).otherwise(0)
    tail = F.when((F.size("words") > 2) & (F.col("words")[F.size("words") - 2] == ""), 1).otherwise(0)
    rows = rows.select("id", "copy", lead.alias("lead"), tail.alias("tail"), F.posexplode("words").alias("pos", "term"))
    found = lookup(rows, numbered, ["term"], "inner")
    pos = F.col("pos") - F.col("lead") - F.when(F.col("term_id") == 0, F.col("tail")).otherwise(0)
    postings = materialize(found.select("term_id", "id", "copy", pos.alias("pos")), "postings")
    counts = postings.groupBy("term_id").count().withColumnRenamed("count", "n")
    return Index(numbered, postings, materialize(counts, "term_counts"))


def windows(items: DataFrame, key: str, text: str, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(window_id, terms) for each distinct run of `size` words, and (item, window_id).

    An item with fewer words, but not none, is one window.
    """
    rows = items.select(F.col(key).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    first = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    rows = rows.select("item", F.explode(F.transform(first, lambda i: F.slice("w", i + 1, size))).alias("terms"))
    rows = materialize(rows.distinct(), "item_windows")
    distinct = rows.select("terms").distinct()
    distinct = materialize(distinct.select(F.sha2(F.array_join("terms", " "), 256).alias("window_id"), "terms"), "windows")
    of = rows.select("item", F.sha2(F.array_join("terms", " "), 256).alias("window_id"))
    return distinct, of


def _by_rarity(index: Index, phrases: DataFrame) -> DataFrame:
    """window_id, length, rank, term_id, offset: the terms of each phrase, rarest first; absent terms rank first."""
    long = phrases.select("window_id", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    known = index.terms.join(index.counts, "term_id").select("term", "term_id", "n")
    long = long.join(known, "term", "left")
    order = Window.partitionBy("window_id").orderBy(F.coalesce("n", F.lit(0)), "term_id", "offset")
    return long.select("window_id", "length", "offset", "term_id", (F.row_number().over(order) - 1).alias("rank"))


def _same(a: str, b: str, *names: str) -> Column:
    """Rows of two aliased tables that agree in these columns and in `id`, null or not."""
    on = F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))
    for name in names:
        on &= F.col(f"{a}.{name}") == F.col(f"{b}.{name}")
    return on


def phrase_matches(index: Index, phrases: DataFrame) -> DataFrame:
    """window_id, id, copy, start, length: every exact occurrence of every phrase (window_id, terms).

    The list of a phrase's rarest term, moved by the term's offset, gives the
    first starts; they are intersected with the moved list of the second
    rarest, then with all the others at once. Each step is an equality join,
    so a frequent term's list is dealt out by document and position.
    """
    ranked = materialize(_by_rarity(index, phrases), "ranked_terms")
    postings = index.postings.filter("term_id > 0")

    def moved(rank: int) -> DataFrame:
        wanted = ranked.filter(F.col("rank") == rank).select("window_id", "length", "offset", "term_id")
        wanted = materialize(wanted.filter("term_id is not null"), "wanted_terms")
        # Several phrases may share the term: gather them, so that each posting finds one row.
        wanted = wanted.groupBy("term_id").agg(F.collect_list(F.struct("window_id", "length", "offset")).alias("w"))
        hits = lookup(postings, materialize(wanted, "wanted_lists"), ["term_id"], "inner")
        hits = hits.select("id", "copy", "pos", F.explode("w").alias("w"))
        return hits.select("w.window_id", "id", "copy", (F.col("pos") - F.col("w.offset")).alias("start"), "w.length").filter("start >= 0")

    first, second = moved(0), moved(1).alias("s")
    longer = first.filter("length > 1").alias("f")
    kept = longer.join(second, _same("f", "s", "window_id", "copy", "start"), "left_semi")
    starts = materialize(first.filter("length = 1").unionByName(kept).distinct(), "starts")

    rest = ranked.filter("rank > 1").groupBy("window_id").agg(F.collect_list(F.struct("term_id", "offset")).alias("rest"))
    need = lookup(starts, materialize(rest, "rest_terms"), ["window_id"]).withColumn("need", F.coalesce(F.size("rest"), F.lit(0)))
    done = need.filter("need <= 0").select("window_id", "id", "copy", "start", "length")
    asked = need.filter("need > 0").select("window_id", "id", "copy", "start", "length", "need", F.explode("rest").alias("r"))
    asked = asked.select(
        "window_id", "id", "copy", "start", "length", "need", F.col("r.term_id").alias("term_id"), (F.col("start") + F.col("r.offset")).alias("pos")
    )
    # Overlapping phrases ask for the same places again and again; each is looked up once.
    places = asked.select("id", "copy", "pos", "term_id").distinct().alias("a")
    at = postings.alias("p")
    there = places.join(at, _same("a", "p", "copy", "pos", "term_id"), "left_semi").alias("t")
    held = asked.alias("q").join(there, _same("q", "t", "copy", "pos", "term_id"), "left_semi")
    full = held.groupBy("window_id", "id", "copy", "start", "length", "need").count().filter("count = need")
    return done.unionByName(full.select("window_id", "id", "copy", "start", "length"))


def proximity_matches(index: Index, phrases: DataFrame, distance: int) -> DataFrame:
    """window_id, id, copy, pos: places of a phrase's rarest term with all its other terms within `distance` words.

    Order does not count; a term that a phrase holds twice is asked for once.
    Places are met through stretches of `distance` positions, each with its two
    neighbours, so no list is paired with another list as a whole.
    """
    ranked = materialize(_by_rarity(index, phrases), "ranked_terms")
    lacking = ranked.filter("term_id is null").select("window_id").distinct()
    ranked = ranked.join(lacking, "window_id", "left_anti").groupBy("window_id", "term_id").agg(F.min("rank").alias("rank"))
    need = ranked.groupBy("window_id").agg((F.count("*") - 1).alias("need"))
    stretch = lambda c: F.floor(F.col(c) / (distance + 1)).cast("int")
    postings = index.postings.filter("term_id > 0")
    anchors = postings.join(ranked.filter("rank = 0").select("window_id", "term_id"), "term_id").join(need, "window_id")
    anchors = materialize(anchors.select("window_id", "id", "copy", "pos", "need"), "anchors")
    others = ranked.filter("rank > 0").select("window_id", F.col("term_id").alias("other"))
    asked = anchors.join(others, "window_id").withColumn("_s", stretch("pos"))
    asked = asked.withColumn("s", F.explode(F.array(F.col("_s") - 1, F.col("_s"), F.col("_s") + 1))).alias("q")
    near = postings.withColumn("s", stretch("pos")).alias("p")
    on = _same("q", "p", "copy", "s") & (F.col("q.other") == F.col("p.term_id"))
    on &= F.abs(F.col("q.pos") - F.col("p.pos")) <= distance
    met = asked.join(near, on, "left_semi").select("window_id", "id", "copy", "pos", "need", "other").distinct()
    met = met.groupBy("window_id", "id", "copy", "pos", "need").count().filter("count = need")
    alone = anchors.filter("need = 0")
    return met.select("window_id", "id", "copy", "pos").union(alone.select("window_id", "id", "copy", "pos")).distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """key, copy, n_words, n_hit, items: for every row, its words inside any occurrence of an item's window.

    `copy` hashes the text. Null texts have no words. Rows with one key and one
    text get the same numbers and stay separate rows. No items, or no
    documents: no hits, or no rows. `items` is the sorted list of item keys as
    strings; a null item key counts like any other but shows as ''.
    """
    phrases, of = windows(items, item_key, item_text, size)
    index = build_index(docs, key, text, phrases.select(F.explode("terms").alias("term")))
    hits = materialize(phrase_matches(index, phrases), "phrase_hits")
    spans = hits.select("id", "copy", "start", "length").distinct()
    covered = spans.select("id", "copy", F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos")).distinct()
    n_hit = covered.groupBy("id", "copy").agg(F.count("*").alias("n_hit"))
    owners = hits.select("window_id", "id", "copy").distinct().join(of, "window_id")
    owners = owners.groupBy("id", "copy").agg(
        F.sort_array(F.collect_set(F.coalesce(F.col("item").cast("string"), F.lit("")))).alias("items")
    )
    found = materialize(
        n_hit.alias("n").join(owners.alias("o"), _same("n", "o", "copy"))
        .select(F.col("n.id").alias("id"), F.col("n.copy").alias("copy"), "n_hit", "items"),
        "contaminated",
    ).alias("h")
    rows = index.postings.filter("term_id = 0").select("id", "copy", F.col("pos").cast("long").alias("n_words")).alias("d")
    return rows.join(found, _same("d", "h", "copy"), "left").select(
        F.col("d.id").alias(key),
        F.col("d.copy").alias("copy"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )
