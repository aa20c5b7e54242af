"""SimHash fingerprints in DataFrame functions alone, and a search within a Hamming radius.

Terms are pairs of neighbouring words, weighted by the length of the longer one (a stand-in for rarity).
Each term's 64-bit hash votes on 64 signs. The votes of four bits share one long, 16 bits each: a
multiplication spreads a half-byte over its four counters, so a term costs 16 additions instead of 64
and stays in generated code. Terms are counted in chunks short enough for 15 bits, then chunks add up.

The search cuts a fingerprint into blocks. Fingerprints at most ``radius`` bits apart agree in all but
``radius`` blocks; there is one table per choice of the blocks that agree, keyed by them, so each pair is
met in an equi-join, and equal fingerprints are met once.

Cases: null text counts as empty; a text without words has fingerprint 0; equal texts have equal
fingerprints; rows that repeat both doc_id and text are one document for what comes next, and each is
reported; equal doc_ids with different texts follow in the order of a hash of the text; null doc_ids
come first; a table of one document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlframe.llm.shared import store, text_of

#: Greatest weight of a term, and terms counted together: their product stays below 2 ** 15.
MAX_WEIGHT, CHUNK = 8, 4000
RADIUS, BLOCKS = 3, 6
_SPREAD, _LANES = 0x200040008001, 0x0001000100010001


def _shift_right(x: Column, n: int) -> Column:
    return F.shiftrightunsigned(x, n) if n else x


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and fp (long) of every row of ``texts`` (keys, text); keys tell rows apart.

    Where ``texts`` is already partitioned by some of the keys, nothing moves.
    """
    words = F.split(F.lower("text"), r"[ \t-\r]+")
    i = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - 2, F.lit(0))))
    terms = texts.select(*keys, words.alias("words")).select(*keys, "words", i.alias("i"))
    one, two = F.get("words", F.col("i")), F.get("words", F.col("i") + 1)
    weight = F.least(F.lit(MAX_WEIGHT), F.greatest(F.length(one), F.coalesce(F.length(two), F.lit(0)))).cast("long")
    terms = terms.select(*keys, F.expr(f"i div {CHUNK}").alias("chunk"), F.xxhash64(one, two).alias("term"), weight.alias("w"))
    lanes = [
        F.sum((_shift_right(F.col("term"), 4 * j).bitwiseAND(15) * F.lit(_SPREAD)).bitwiseAND(_LANES) * F.col("w")).alias(f"s{j}") for j in range(16)
    ]
    chunks = terms.groupBy(*keys, "chunk").agg(*lanes, F.sum("w").alias("w"))
    votes = [F.sum(_shift_right(F.col(f"s{b // 4}"), 16 * (b % 4)).bitwiseAND(0xFFFF)).alias(f"v{b}") for b in range(64)]
    signs = chunks.groupBy(*keys).agg(*votes, F.sum("w").alias("w"))
    bits = [F.when(2 * F.col(f"v{b}") > F.col("w"), F.lit((1 << b) - (1 << 64 if b == 63 else 0))).otherwise(F.lit(0)) for b in range(64)]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return signs.select(*keys, bits[0].cast("long").alias("fp"))


def likeness(a: str, b: str) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / 64.0


def _neighbours(docs: DataFrame) -> DataFrame:
    """o, h (order: doc_id, then text), doc_id, times, and before each: po, ph, pn (its code points). The first comes after the last.

    Ids alone are ranged; what lies across the ends of ranges is one row per range.
    """
    ids = docs.groupBy("o", "h").agg(F.count("*").alias("times"), F.max("n").alias("n"), F.max("doc_id").alias("doc_id"))
    ids = store(ids.repartitionByRange("o", "h").withColumn("part", F.spark_partition_id()), "order")
    inner = Window.partitionBy("part").orderBy("o", "h")
    own = F.struct("o", "h", "n")
    ends = ids.groupBy("part").agg(F.max(own).alias("last"))
    # one row per range
    every = Window.orderBy("part")
    whole = Window.partitionBy(F.lit(1))
    ends = ends.withColumn("wrap", F.max("last").over(whole)).select("part", F.coalesce(F.lag("last").over(every), "wrap").alias("edge"))
    before = F.coalesce(F.lag(own).over(inner), "edge")
    return ids.join(ends, "part").withColumn("b", before).select("o", "h", "doc_id", "times", F.col("b.o").alias("po"), F.col("b.h").alias("ph"), F.col("b.n").alias("pn"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how alike they and the next document's are.

    Edited: the last quarter of the code points is replaced by as many first ones of the next document.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, fp.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).withColumn("o", order).withColumn("h", F.xxhash64("text"))
    beside = store(_neighbours(keyed.select("o", "h", "doc_id", F.length("text").alias("n"))), "beside")
    first = F.row_number().over(Window.partitionBy("o", "h").orderBy("o"))
    # used twice with the same columns, so the texts are shuffled once
    texts = keyed.select("o", "h", "text").withColumn("first", first).filter("first = 1").drop("first")
    tails = texts.join(beside, ["o", "h"]).select(F.col("po").alias("o"), F.col("ph").alias("h"), F.expr("left(text, cast(floor(pn / 4) as int))").alias("tail"))
    n = F.length("text")
    edited = F.concat(F.expr("left(text, cast(length(text) - floor(length(text) / 4) as int))"), F.col("tail"))
    both = texts.join(tails, ["o", "h"]).select("o", "h", n.cast("long").alias("n_chars"), F.array("text", edited).alias("forms"))
    forms = both.select("o", "h", "n_chars", F.posexplode("forms").alias("form", "text"))
    digest = F.when(F.col("form") == 1, F.sha2(F.encode("text", "utf-8"), 256))
    forms = forms.withColumn("edited_sha256", digest)
    found = fingerprints(forms, ["o", "h", "n_chars", "form", "edited_sha256"])
    pick = lambda c, form: F.max(F.when(F.col("form") == form, F.col(c)))
    wide = found.groupBy("o", "h", "n_chars").agg(pick("fp", 0).alias("fp"), pick("fp", 1).alias("edited_fp"), F.max("edited_sha256").alias("edited_sha256"))
    wide = store(wide, "fingerprints")
    following = wide.select("o", "h", F.col("fp").alias("next_fp")).join(beside.select("o", "h", "po", "ph"), ["o", "h"]).select(
        F.col("po").alias("o"), F.col("ph").alias("h"), "next_fp"
    )
    out = wide.join(following, ["o", "h"]).join(beside.select("o", "h", "doc_id", "times"), ["o", "h"])
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text("fp").alias("fingerprint"),
        text("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
        "fp",
        F.explode(F.sequence(F.lit(1), "times")).alias("_copy"),
    ).drop("_copy")


def _tables(fp: Column, radius: int, blocks: int) -> Column:
    """One key per choice of the blocks that agree: the table's number and the blocks' bits."""
    cuts = [64 * b // blocks for b in range(blocks + 1)]
    keys = []
    for number, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << cuts[b + 1]) - (1 << cuts[b])) for b in kept)
        mask -= 1 << 64 if mask >> 63 else 0
        keys.append(F.struct(F.lit(number).alias("table"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*keys)


def within_radius(table: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs (query_fp, fp, distance) of distinct fingerprints of ``queries`` and ``table`` (fp) at most ``radius`` apart."""
    keyed = table.select("fp").distinct().select("fp", F.explode(_tables(F.col("fp"), radius, blocks)).alias("key"))
    asked = queries.select(F.col("fp").alias("query_fp")).distinct()
    asked = asked.select("query_fp", F.explode(_tables(F.col("query_fp"), radius, blocks)).alias("key"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("query_fp")))
    met = keyed.select("fp", "key.*").join(asked.select("query_fp", "key.*"), ["table", "bits"]).filter(distance <= radius)
    return met.select("query_fp", "fp").distinct().withColumn("distance", distance)


def near_counts(prints: DataFrame, queries: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``prints`` (fp and others) with n_near: documents within the radius, for rows that meet ``queries``; null for others."""
    sizes = prints.groupBy("fp").agg(F.count("*").alias("size"))
    pairs = within_radius(sizes, prints.filter(queries), radius, blocks)
    counts = pairs.join(sizes, "fp").groupBy("query_fp").agg(F.sum("size").alias("n_near"))
    joined = prints.join(counts, prints["fp"] == counts["query_fp"], "left")
    return joined.select(*prints.columns[:-1], F.when(queries, F.col("n_near") - 1).alias("n_near"))
