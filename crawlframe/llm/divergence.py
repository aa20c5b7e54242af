"""How the words of each source differ from those of the other sources, and of all documents, of its language.

Identical texts of a language collapse to one row with a multiplicity for each source, so every distinct
text is tokenised once; its terms add their document frequency and counts times those multiplicities. A
term is a run of letters A-Z (lower-cased) and characters beyond ASCII; a language keeps the terms that
``min_docs`` of its documents have. A count c among N becomes p = 1 + floor(10^9 (c + 1) / (N + V)), where
V terms are kept; f(p, q) = floor((p - q)^2 / q) compares two of them.

Part ``pair`` sums f over all kept terms for each two sources of a language. Nearly all counts are 0, and
all terms with count 0 in a source have one p, here p0. So the sum is V f(p0, q0), plus what each term of either source
adds against the other's q0 or p0, plus a correction for the terms both have; only that last part joins
terms, and it makes a row for two sources that share a term. Part ``term`` lists what lifts a source above its language.

No text is joined or grouped whole: copies are found by the SHA-256 of the text, and one copy a task is shuffled.
Counting is map-side in Python (a table of ``LIMIT`` entries is handed on when full), then partial sums. All
arithmetic is on integers: 64 bits where the bound is proven (p <= 10^9 + 1, f <= 10^18), decimals of 38 digits elsewhere.

Cases: null text, lang and source count as ''; a document without terms still makes its group occur; a group without
kept terms has p0 = 1 + floor(10^9 / V); a language with V = 0 has ``pair`` rows of value 0 and no ``term`` rows; a language of
one source has no ``pair`` rows; repeated rows count as often as they occur; an empty table gives an empty result;
other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import lean_batches, store, text_of

#: Entries of a task's table of counts; it is handed on and begun anew when it has more.
LIMIT = 400_000
#: Every byte that no term has becomes a space, and A-Z is lower-cased; bytes of longer UTF-8 sequences stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_TABLE).split()


def weighted_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of (lang, source, term) over distinct texts: occurrences and documents, each times the source's copies."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), own in counts.items():
            docs = documents[lang, source]
            terms = list(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([own[t] for t in terms], pa.int64()),
                    pa.array([docs[t] for t in terms], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()
        documents.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        texts = batch.column(1).cast(pa.large_binary())
        for i, (lang, copies) in enumerate(zip(langs, sources, strict=True)):
            terms = terms_of(texts[i].as_py())
            if not terms:
                continue
            once = Counter(terms) if len(copies) > 1 or copies[0]["copies"] > 1 else None
            for c in copies:
                own, docs = counts[lang, c["source"]], documents[lang, c["source"]]
                held -= len(own)
                if once is None:
                    own.update(terms)
                    docs.update(set(terms))
                else:
                    n = c["copies"]
                    for term, k in once.items():
                        own[term] += k * n
                        docs[term] += n
                held += len(own)
            if held > LIMIT:
                yield from flush()
                held = 0
    yield from flush()


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies of each text by (lang, source), and distinct texts with the list of these."""
    rows = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of().alias("text"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.encode("text", "utf-8"), 256)))
    copies = store(rows.groupBy("lang", "key", "source").agg(F.count("*").alias("copies")), "copies")
    sources = copies.groupBy("lang", "key").agg(F.collect_list(F.struct("source", "copies")).alias("sources"))
    texts = rows.filter("text <> ''").groupBy("lang", "key").agg(F.first("text").alias("text"))
    return copies, texts.join(sources, ["lang", "key"]).select("lang", "text", "sources")


def smoothed(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept))."""
    wide = lambda c: F.col(c) if isinstance(c, str) else c
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (wide(count) + 1).cast("decimal(19,0)")
    return F.call_function("div", top, (wide(total) + wide(kept)).cast("decimal(19,0)")) + 1


def distance(p: Column | str, q: Column | str) -> Column:
    """floor((p - q)^2 / q); both are at most 10^9 + 1."""
    p, q = (F.col(c) if isinstance(c, str) else c for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), q)


def _exact_sum(value: Column) -> Column:
    """The sum of longs that may pass 64 bits, from two sums that don't."""
    high, low = F.sum(F.shiftright(value, 32)), F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF)))
    return high.cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(38,0)")


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, all) of the terms that enough documents of the language have; ``all``: its occurrences there."""
    sums = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"))
    return sums.filter(F.col("docs") >= min_docs).select("lang", "term", "all")


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the first ``top`` terms of each source."""
    copies, texts = collapsed(docs)
    lean_batches(docs, 1000)
    counted = texts.mapInArrow(weighted_counts, _COUNTS)
    counts = store(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    kept = store(kept_terms(counts, min_docs), "kept")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("lang_n"))
    own = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = copies.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["v", "lang_n", "group_n"])
    # a language without kept terms compares nothing: any p0 will do
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, smoothed(F.lit(0), "group_n", "v")).otherwise(F.lit(1)).cast("long"))
    groups = store(groups, "groups")
    own = own.join(groups, ["lang", "source"])
    own = own.withColumn("p", smoothed("n", "group_n", "v")).withColumn("q", smoothed("all", "lang_n", "v"))
    own = store(own.select("lang", "source", "term", "p", "p0", "q"), "own")
    return _ranked(_pairs(own, groups), "pair", None).unionByName(_ranked(_lifted(own), "term", top))


def _lifted(own: DataFrame) -> DataFrame:
    return own.filter("p > q").select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))


def _pairs(own: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language."""
    wide = lambda c: c.cast("decimal(38,0)")
    side = groups.select("lang", "source", "p0", "v")
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = side.join(other, "lang").filter("source <> item")
    base = base.select("lang", "source", "item", (wide(F.col("v")) * wide(distance("p0", "q0"))).alias("value"))
    # terms of one side against the other's p0: as often as a p occurs
    alike = store(own.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")), "alike")
    met = alike.join(other, "lang").filter("source <> item")
    forth = met.select("lang", "source", "item", (distance("p", "q0") - distance("p0", "q0")).alias("d"), "terms")
    back = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (distance("q0", "p") - distance("q0", "p0")).alias("d"), "terms")
    single = forth.unionByName(back).groupBy("lang", "source", "item").agg(F.sum(wide(F.col("d")) * wide(F.col("terms"))).alias("value"))
    # terms of both sides: what the two parts above have wrong
    a = own.select("lang", "term", "source", "p", "p0")
    b = own.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("p0").alias("r0"))
    both = a.join(b, ["lang", "term"]).filter("source < item")

    def correction(p: str, p0: str, r: str, r0: str) -> Column:
        return distance(p, r) - distance(p, r0) - distance(p0, r) + distance(p0, r0)

    sums = both.groupBy("lang", "source", "item").agg(
        _exact_sum(correction("p", "p0", "r", "r0")).alias("value"), _exact_sum(correction("r", "r0", "p", "p0")).alias("turned")
    )
    sums = store(sums, "both")
    shared = sums.select("lang", "source", "item", "value").unionByName(
        sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("turned").alias("value"))
    )
    parts = base.unionByName(single).unionByName(shared)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, sum(k) AS n, count(*) AS docs
  FROM (SELECT lang, source, term, count(*) AS k FROM (SELECT row_number() OVER () AS i, * FROM d) t, unnest(t.terms) AS u(term) GROUP BY i, lang, source, term)
  GROUP BY 1, 2, 3),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY 1, 2 HAVING sum(docs) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS lang_n
  FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000::HUGEINT * (f.n + 1)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (f.lang_n + 1)) // (l.total + l.v) AS q
  FROM full_counts f JOIN l ON l.lang = f.lang),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY 1, 2, 4),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
