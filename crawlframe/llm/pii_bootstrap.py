"""Personal data: fixed forms, and identifiers that bootstrapped contexts discover.

Fixed forms (mail addresses, IPv4 addresses, card numbers that pass Luhn's check, international phone
numbers) are the seeds. The words around a seed, with the shape of what they enclose, are its patterns. A
bipartite graph links patterns with the instances (identifier-like strings) they enclose anywhere in the
corpus. Rounds over it as Spark aggregates: a pattern lives once it meets an instance above the bar, be it
a seed or discovered in a round before; it is as reliable as the mean of its instances, with
a prior against small samples; an instance as its best patterns together. Scores only rise, so the rounds
end: when no further instance passes the bar. Instances of no fixed form that end above it are reported
as ``found``.

A pattern or instance that is very frequent is a plain sum with map-side parts; nothing is gathered per
pattern. Scores live in tables written to the shared folder between rounds.

Cases: null or empty text has no span; repeated rows are each reported; texts are searched whole in
linear time; an empty table gives an empty result; other columns are kept by ``redact`` and not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.shared import store, text_of
from crawlframe.llm.spans import holders, text_bytes

KINDS = ("email", "ip", "card", "phone", "found")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits can only begin a match at its first digit and only go on behind its last
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Identifier-like: six characters or more with four digits or more among them.
_INSTANCE = re.compile(r"(?<![A-Za-z0-9_@./-])[A-Za-z0-9][A-Za-z0-9_@./-]{4,62}[A-Za-z0-9](?![A-Za-z0-9_@/-])")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters around a span in which its context words are sought.
_CONTEXT = 64
_DIGITS = tuple(str(d).encode() for d in range(10))

#: Least number of rounds; more follow as long as instances pass the bar for the first time.
ROUNDS = 3
#: Weight of the prior (of reliability 0) in a pattern's mean, as instances.
PRIOR = 3.0
#: Least score of a discovered instance.
BAR = 0.6
#: Discovered spans up to this many are sent to all tasks (32 bytes each); more meet their texts in a shuffle.
BROADCAST_SPANS = 200_000


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
        # without a match, nothing left of the next sign can begin one before this sign
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed forms of a text, in code points."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _shape(value: str) -> str:
    """Runs of letters, digits and others as one sign each with a rounded length."""
    out = []
    for m in re.finditer(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]", value):
        own = m[0]
        out.append(own if not own.isalnum() else ("9" if own[0].isdigit() else "a") + ("+" if len(own) > 4 else ""))
    return "".join(out)


def _occurrences(text: str) -> list[dict]:
    """Base spans and other identifier-like strings, with their context."""
    spans = base_spans(text)
    taken = sorted((a, b) for _, a, b in spans)
    at = 0
    for m in _INSTANCE.finditer(text):
        if sum(c.isdigit() for c in m[0]) < 4:
            continue
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            spans.append(("", m.start(), m.end()))
    out = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        before = _WORD.findall(text[max(0, a - _CONTEXT) : a])[-2:]
        after = _WORD.findall(text[b : b + _CONTEXT])[:1]
        out.append(
            {
                "kind": kind, "start": a, "end": b, "value": text[a:b].lower(),
                "left": " ".join(before).lower(), "right": "".join(after).lower(), "shape": _shape(text[a:b]),
            }
        )
    return out


def _scan(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (tells repeated ids apart), n_chars and occurrences of every row."""

    fields = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())] + [(c, pa.string()) for c in ("value", "left", "right", "shape")]
    kind = pa.list_(pa.struct(fields))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                data, offsets = text_bytes(part.column(2))
                found: list[list] = [[] for _ in range(part.num_rows)]
                for i in holders(data, offsets, (b"@", *_DIGITS)):
                    found[i] = _occurrences(part.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, kind)], names=["doc_id", "text_key", "found"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    schema = "doc_id long, text_key long, found array<struct<kind:string,start:long,end:long,value:string,left:string,right:string,shape:string>>"
    return rows.mapInArrow(scan, schema)


def _patterns() -> Column:
    """The contexts of an occurrence, from wide to narrow; a context word is needed on a side."""
    left, last = F.col("left"), F.substring_index("left", " ", -1)
    parts = [(left, F.lit("")), (last, F.col("right")), (F.lit(""), F.concat(F.col("right"), F.lit(" "), F.col("shape"))), (last, F.col("shape"))]
    return F.array(*[F.concat(F.lit(str(i)), F.lit("\t"), a, F.lit("\t"), b) for i, (a, b) in enumerate(parts)])


def discovered(occurrences: DataFrame, rounds: int = ROUNDS, prior: float = PRIOR, bar: float = BAR) -> DataFrame:
    """value, score of the instances that the patterns of the seeds, and those of what these discover, reach."""
    seeds = store(occurrences.filter("kind <> ''").select("value").distinct().withColumn("score", F.lit(1.0)), "seeds")
    links = occurrences.select("value", F.explode(_patterns()).alias("pattern")).groupBy("value", "pattern").agg(F.count("*").alias("times"))
    # an instance counts once for a pattern, and only patterns that can carry a score from one instance to another that is no seed matter
    score = F.coalesce("score", F.lit(0.0))
    known = links.join(seeds, "value", "left").withColumn("score", score).groupBy("pattern")
    useful = known.agg(F.count("*").alias("instances"), F.min("score").alias("lo")).filter("instances > 1 and lo = 0").select("pattern")
    links = store(links.join(useful, "pattern"), "links")
    scores, passed, done = seeds, -1, 0
    while True:
        rated = links.join(scores, "value", "left").groupBy("pattern").agg((F.sum(score) / (F.count("*") + prior)).alias("trust"), F.max(score).alias("hi"))
        rated = rated.filter(F.col("hi") >= bar).drop("hi")
        # several patterns that agree: one minus the chance that all are wrong
        doubt = F.sum(F.log1p(-F.least("trust", F.lit(0.999))))
        found = links.join(rated, "pattern").groupBy("value").agg((1 - F.exp(doubt / 2)).alias("reached"))
        merged = found.join(seeds, "value", "full").select("value", F.greatest(F.coalesce("reached", F.lit(0.0)), score).alias("score"))
        scores = store(merged, "scores")
        done, before, passed = done + 1, passed, scores.filter(F.col("score") >= bar).count()
        if done >= rounds and passed == before:
            break
    return scores.join(seeds.select("value"), "value", "left_anti").filter(F.col("score") >= bar)


def _with_found(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """The scan of all rows, stored, and per (doc_id, text_key) the spans of discovered instances."""
    scanned = store(_scan(docs), "scan")
    occurrences = scanned.select("doc_id", "text_key", F.explode("found").alias("o")).select("doc_id", "text_key", "o.*")
    values = discovered(occurrences.select("kind", "value", "left", "right", "shape"), **options).select("value")
    other = occurrences.filter("kind = ''").select("doc_id", "text_key", "start", "end", "value").distinct()
    spans = other.join(values, "value").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct(F.lit("found").alias("kind"), "start", "end")).alias("more"))
    return scanned, spans


def personal_spans(docs: DataFrame, **options) -> DataFrame:
    """doc_id and spans (array of kind, start, end in code points) of every row of ``docs`` (doc_id, text)."""
    scanned, more = _with_found(docs, **options)
    base = F.transform(F.filter("found", lambda o: o["kind"] != ""), lambda o: F.struct(o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")))
    more = more.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    spans = F.concat(base, F.coalesce("more", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")))
    return scanned.join(more, same, "left").select("doc_id", spans.alias("spans"))


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (``[EMAIL]``), and n_chars to match; all their columns."""
    _, more = _with_found(docs, **options)
    more = store(more.withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "more": "_spans"}), "found")
    if (more.select(F.sum(F.size("_spans") + 1)).first()[0] or 0) <= BROADCAST_SPANS:
        more = F.broadcast(more)
    joined = docs.join(more, docs["doc_id"].cast("long").eqNullSafe(more["_id"]) & (F.xxhash64(text_of()) == more["_key"]), "left")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, extra = batch.schema.get_field_index("text"), batch.schema.get_field_index("_spans")
            data, offsets = text_bytes(batch.column(at).fill_null(""))
            texts = None
            for i in sorted(holders(data, offsets, (b"@", *_DIGITS))):
                text = batch.column(at)[i].as_py()
                spans = base_spans(text) + [(s["kind"], s["start"], s["end"]) for s in batch.column(extra)[i].as_py() or ()]
                if spans:
                    texts = texts or batch.column(at).to_pylist()
                    out, done = [], 0
                    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                        if a >= done:
                            out += [text[done:a], f"[{kind.upper()}]"]
                        done = max(done, b)
                    texts[i] = "".join([*out, text[done:]])
            columns = list(batch.columns)
            if texts:
                columns[at] = pa.array(texts, batch.schema.field(at).type)
            kept = [i for i in range(len(columns)) if i != extra]
            yield pa.RecordBatch.from_arrays([columns[i] for i in kept], names=[batch.schema.names[i] for i in kept])

    out = joined.select(*[docs[c] for c in docs.columns], "_spans").mapInArrow(rewrite, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
