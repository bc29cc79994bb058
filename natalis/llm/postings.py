"""Benchmark decontamination with a distributed positional inverted index.

The rarest words of every test window (by their count in all training texts) make the list of terms. The
index is stored: the postings (term, document, position) of these terms over every training token; a term that
no test item asks for is not stored. Phrases and proximity both read it. A posting, less the term's place in the item, is a
possible place of the item in the document; lists are intersected on it, rarest terms first, and what is left is compared
word by word with the whole window. For proximity the two rarest terms of a window stand at most so many words apart, in any
order, and words that no training text has don't matter. Only DataFrame operations; texts are only split again where an
intersection is not empty.

Words are runs of ASCII letters, digits and non-ASCII characters with A-Z lower-cased. A window is ``size``
consecutive words of an item; an item of fewer words, but not none, is one window.

Defined results: null and empty texts have no words, and such items no windows; rows are told apart by id and text, a null id
being an id like others, so rows of equal id and different text are judged apart and equal rows alike; equal items are judged one
by one, several texts of one item count for it together, and items without an id are one item without a name; an empty test set or
training table gives no hits. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import cut, table

SIZE = 13
#: Rarest terms of a window whose lists are intersected before words are compared.
RAREST = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a side up to which the test side is broadcast: some 64 MB.
BROADCAST_ROWS = 500_000


def lowered(text: Column) -> Column:
    """A-Z lower-cased; texts of ASCII alone, where that is what lower() does, take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order."""
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), GAPS), lambda w: w != "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select("id", F.posexplode("words").alias("at", "term"))


def _test_windows(items: DataFrame, size: int) -> DataFrame:
    """(item, words, windows): the starts of an item's windows and their length."""
    items = items.where(F.size("words") > 0)
    length = F.least(F.lit(size), F.size("words"))
    return items.withColumn("length", length).withColumn("starts", F.sequence(F.lit(0), F.size("words") - F.col("length")))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n) over all tokens of docs (id, words) for the wanted terms; those that never occur are left out."""
    tokens = docs.select(F.explode("words").alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))


def rarest(items: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """(item, start, length, terms, known, rare): every window with a word that a training text has, the number of its
    different words and of those that training texts have, and (n, place, term) of its rarest; equal terms count once.
    """
    places = items.select("item", "length", F.explode("starts").alias("start"), "words")
    places = places.select("item", "length", "start", F.posexplode(F.expr("slice(words, start + 1, length)")).alias("k", "term"))
    places = places.withColumn("place", F.col("start") + F.col("k"))
    places = places.join(counts, "term", "left")
    one = places.groupBy("item", "start", "length", "term").agg(F.min("place").alias("place"), F.min("n").alias("n"))
    ranked = F.slice(F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "place", "term")))), 1, most)
    windows = one.groupBy("item", "start", "length").agg(F.count("*").alias("terms"), F.count("n").alias("known"), ranked.alias("rare"))
    return windows.where("known > 0")


class Index:
    """The stored postings (term, id, at) of the rarest terms of all windows, over every token of docs (id, words)."""

    def __init__(self, docs: DataFrame, items: DataFrame, size: int = SIZE):
        self.docs, self.items, self.size = docs, cut(items), size
        vocabulary = cut(self.items.select(F.explode("words").alias("term")).distinct())
        counts = cut(term_counts(docs, _small(vocabulary, vocabulary.count())))
        self.windows = cut(rarest(_test_windows(self.items, size), counts, RAREST))
        terms = cut(self.windows.select(F.explode("rare.term").alias("term")).distinct())
        self.postings = cut(_tokens(docs).join(_small(terms, terms.count()), "term").select("term", "id", "at"))

    def candidates(self) -> DataFrame:
        """(id, item, shift, starts): where the rarest terms of windows meet; word ``k`` of the item would be word ``shift + k``."""
        # a window with a term that no training text has can't occur
        windows = self.windows.where("terms = known")
        asked = cut(windows.select("item", F.explode("rare").alias("r")).select("item", F.col("r.term").alias("term"), F.col("r.place").alias("place")).distinct())
        rows = asked.count()
        met = self.postings.join(_small(asked, rows), "term").select("id", "item", (F.col("at") - F.col("place")).alias("shift"), "place")
        met = met.where("shift > -place - 1").groupBy("id", "item", "shift").agg(F.collect_set("place").alias("places"))
        wanted = windows.groupBy("item").agg(F.collect_list(F.struct("start", "length", F.expr("transform(rare, r -> r.place)").alias("places"))).alias("windows"))
        met = met.join(_small(wanted, rows), "item")
        starts = F.expr("transform(filter(windows, w -> shift + w.start >= 0 and size(array_except(w.places, places)) = 0), w -> w.start)")
        return met.select("id", "item", "shift", starts.alias("starts")).where("size(starts) > 0")

    def phrases(self) -> DataFrame:
        """(id, item, shift, start, length): every exact occurrence of a window of an item, at word ``shift + start`` of the document."""
        found = cut(self.candidates())
        rows, size = found.count(), self.size
        # of the texts only those of candidates are split, and none is shuffled while these are few
        ids = _small(found.select("id").distinct(), rows)
        pairs = self.docs.join(ids, "id", "left_semi").join(_small(found, rows), "id")
        pairs = pairs.join(_small(self.items.select("item", F.col("words").alias("asked")), self.items.count()), "item")
        length = F.least(F.lit(size), F.size("asked")).alias("length")
        pairs = pairs.select("id", "item", "shift", length, F.expr("filter(starts, s -> slice(words, shift + s + 1, least(%d, size(asked))) = slice(asked, s + 1, least(%d, size(asked))))" % (size, size)).alias("starts"))
        return pairs.select("id", "item", "shift", F.explode("starts").alias("start"), "length").distinct()

    def pairs_within(self, within: int) -> tuple[DataFrame, DataFrame]:
        """(id, one, two, first, last): the two rarest terms of a window at most ``within`` words apart; and (item, start, one, two) of the windows.

        Positions are bucketed by ``within``, so that only postings of neighbouring buckets meet.
        """
        windows = self.windows.where("size(rare) > 1 or terms = 1")
        windows = cut(windows.select("item", "start", F.col("rare")[0]["term"].alias("one"), F.expr("coalesce(get(rare, 1).term, rare[0].term)").alias("two")))
        asked = cut(windows.select("one", "two").distinct())
        placed = self.postings.withColumn("cell", F.floor(F.col("at") / (within + 1)))
        one = placed.join(_small(asked, asked.count()), F.col("term") == F.col("one"))
        one = one.select("id", "one", "two", F.col("at").alias("a"), F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])).alias("cell"))
        two = placed.select("id", F.col("term").alias("two"), F.col("at").alias("b"), "cell")
        found = one.join(two, ["id", "two", "cell"]).where(F.abs(F.col("a") - F.col("b")) <= within)
        return found.select("id", "one", "two", F.least("a", "b").alias("first"), F.greatest("a", "b").alias("last")), windows


def phrase_matches(docs: DataFrame, items: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, item, shift, start, length): every exact occurrence of a window; docs is (id, words), items is (item, words)."""
    return Index(docs, items, size).phrases()


def proximity_matches(docs: DataFrame, items: DataFrame, within: int, size: int = SIZE) -> DataFrame:
    """(id, item, start, first, last): the rarest terms of a window standing in a document at most ``within`` words apart, in any
    order. First and last are positions of the document.
    """
    found, windows = Index(docs, items, size).pairs_within(within)
    return found.join(_small(windows, windows.count()), ["one", "two"]).select("id", "item", "start", "first", "last").distinct()


def _named(id_: str) -> Column:
    """The id as a string that null has too."""
    return F.coalesce(F.concat(F.lit("+"), F.col(id_).cast("string")), F.lit("-"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = SIZE, share: int = 20) -> DataFrame:
    """(id, text_hash, n_words, n_hit, items, n_near, contaminated) for every document: its words inside an occurrence of any
    window, the items that occur, and the number of items of which a window's rarest terms stand within ``size`` words.

    Contaminated are documents with a hit and at least one hit word in ``share``. Rows of equal id are told apart by the hash of their text.
    """
    hash_ = F.xxhash64(F.col(text))
    row = F.concat_ws(" ", _named(id_), F.hex(hash_))
    texts = docs.select(F.col(id_).alias("own"), hash_.alias("text_hash"), row.alias("id"), words(F.col(text)).alias("words"))
    items = benchmark.select(_named(item).alias("item"), words(F.col(item_text)).alias("words"))
    item_type = benchmark.schema[item].dataType
    index = Index(texts.select("id", "words"), items, size)
    found = index.phrases()
    spans = found.select("id", "item", (F.col("shift") + F.col("start")).alias("at"), "length")
    by_doc = spans.groupBy("id").agg(F.collect_set("item").alias("items"), F.array_sort(F.collect_set(F.struct("at", "length"))).alias("spans"))
    # spans in order: each adds the words past the furthest end so far
    hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(s["end"], x["at"]))).alias("n"),
            F.greatest(s["end"], x["at"] + x["length"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    by_doc = by_doc.select("id", "items", hit.alias("hit"))
    by_doc = cut(by_doc.select("id", F.transform("items", lambda x: F.when(x != "-", F.substring(x, 2, 1 << 30)).cast(item_type)).alias("items"), "hit"))
    close, windows = index.pairs_within(size - 1)
    asked = cut(windows.select("item", "one", "two").distinct())
    near = close.select("id", "one", "two").distinct().join(_small(asked, asked.count()), ["one", "two"])
    near = cut(near.groupBy("id").agg(F.count_distinct("item").alias("n_near")))
    sizes = texts.select("own", "text_hash", "id", F.size("words").cast("long").alias("n_words"))
    out = sizes.join(_small(by_doc, by_doc.count()), "id", "left").join(_small(near, near.count()), "id", "left")
    out = out.withColumn("n_hit", F.coalesce("hit", F.lit(0)).cast("long"))
    none = F.array().cast(by_doc.schema["items"].dataType)
    contaminated = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.select(F.col("own").alias("id"), "text_hash", "n_words", "n_hit", F.coalesce("items", none).alias("items"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), contaminated.alias("contaminated"))


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged against all benchmark windows of 13 words, by phrases and by proximity."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"), "contaminated", "n_near")


OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM wins),
spots AS (
  SELECT doc_id, s, x.k, x.item_id
  FROM (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM dw, sizes WHERE len(w) >= k)) d
  JOIN wins x ON d.k = x.k AND d.g = x.g),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM spots) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM spots GROUP BY doc_id),
tokens AS (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS at FROM dw),
counts AS (SELECT term, count(*) AS n FROM tokens GROUP BY term),
places AS (
  SELECT item_id, s, k, term, min(p) AS p FROM (
    SELECT item_id, s, k, unnest(w[s:s + k - 1]) AS term, unnest(range(s, s + k)) AS p
    FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM bw WHERE len(w) > 0))
  GROUP BY item_id, s, k, term),
rare AS (
  SELECT item_id, s, count(*) AS terms, list(term ORDER BY n, p, term) FILTER (n IS NOT NULL) AS known
  FROM places LEFT JOIN counts USING (term) GROUP BY item_id, s, k),
asked AS (
  SELECT DISTINCT item_id, known[1] AS one, coalesce(known[2], known[1]) AS two FROM rare
  WHERE len(known) > 0 AND (len(known) > 1 OR terms = 1)),
wanted AS (SELECT * FROM tokens WHERE term IN (SELECT one FROM asked UNION SELECT two FROM asked)),
near AS (
  SELECT a.doc_id, count(DISTINCT item_id) AS n_near
  FROM asked JOIN wanted a ON a.term = one JOIN wanted b ON b.doc_id = a.doc_id AND b.term = two
  WHERE abs(a.at - b.at) <= 12 GROUP BY a.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near
FROM dw d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN near USING (doc_id)
"""
