"""Rule texts as tables: deny rules, accept/reject patterns, rewrites, public suffixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F



def valid_regex(pattern: Column) -> Column:
    """Whether the JVM's regex compiler takes the pattern."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), pattern, F.lit("")).isNotNull()


def numbered_lines(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """One row per line of every text: ``doc, pos, line``. Narrow."""
    lines = F.posexplode(F.split(F.col(text), r"\r?\n", -1)).alias("pos", "line")
    return texts.select(F.col(doc).alias("doc"), lines)


def carry_section(lines: DataFrame, header: Column, doc: str = "doc", pos: str = "pos") -> DataFrame:
    """Give every line the last header at or above it in the same text, as column ``section``."""
    above = W.partitionBy(doc).orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(header, ignorenulls=True).over(above))


def deny_rule_lines(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """Every meaningful line with its section and what became of it (``state``)."""
    lines = numbered_lines(texts, doc, text)
    clean = lines.withColumn("line", F.btrim(F.substring_index("line", "#", 1), F.lit(" \t\r\f"))).filter("line <> ''")
    words = F.split("line", r"\s+", -1)
    is_host = F.col("line").startswith("Host")
    is_domain = F.col("line").startswith("Domain")
    is_header = is_host | is_domain
    # a header without a name opens nothing and does not close the section above it
    header = F.when(
        is_header & (F.size(words) > 1),
        F.struct(F.when(is_host, "host").otherwise("domain").alias("scope"), words[1].alias("key")),
    )
    return carry_section(clean.withColumn("is_header", is_header), header).select(
        "doc", "pos", "line", "is_header", F.get(words, F.lit(1)).alias("word"), "section"
    )


def parse_deny_rules(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """Deny rules of rule texts: ``doc, seq, scope, key, kind, pattern``."""
    lines = deny_rule_lines(texts, doc, text).filter(~F.col("is_header") & F.col("section").isNotNull())
    line = F.col("line")
    kind = (
        F.when(line.rlike(r"^DenyPath(?:Query)?\s+\.[*?]$"), "all")
        .when(line.startswith("DenyPathQuery"), "pathquery")
        .when(line.startswith("DenyPath"), "path")
    )
    pattern = F.when(kind == "all", F.lit(".")).otherwise(F.col("word"))
    rules = lines.select(
        "doc",
        F.col("pos").cast("bigint").alias("seq"),
        F.col("section.scope").alias("scope"),
        F.col("section.key").alias("key"),
        kind.alias("kind"),
        pattern.alias("pattern"),
    )
    return rules.filter(F.col("kind").isNotNull() & F.col("pattern").isNotNull()).filter(
        (F.col("kind") == "all") | valid_regex(F.col("pattern"))
    )


def read_deny_rules(spark: SparkSession, path: str) -> DataFrame:
    """Read rule texts (plain or gzip, any file system Spark knows)."""
    texts = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text")
    )
    return parse_deny_rules(texts).drop("doc")


def skipped_rule_lines(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """Lines that gave no rule and no section, for a report after loading."""
    lines = deny_rule_lines(texts, doc, text)
    used = parse_deny_rules(texts, doc, text).select("doc", F.col("seq").cast("int").alias("pos"))
    named = F.col("is_header") & F.col("word").isNotNull()
    return lines.filter(~named).join(used, ["doc", "pos"], "left_anti").select("doc", "pos", "line")


def rule_stats(rules: DataFrame) -> DataFrame:
    """Loaded rules per scope. A repeated catch-all under one key counts once."""
    catch_all = F.count_distinct(F.when(F.col("kind") == "all", F.col("key")))
    return rules.groupBy("scope").agg(
        (F.count(F.when(F.col("kind") != "all", F.lit(1))) + catch_all).alias("n_rules")
    )


def parse_regex_rules(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """``+pattern`` / ``-pattern`` lines in order: ``doc, seq, accept, pattern``."""
    lines = numbered_lines(texts, doc, text).withColumn("line", F.rtrim("line"))
    sign = F.substring("line", 1, 1)
    return (
        lines.filter(sign.isin("+", "-"))
        .select(
            "doc",
            F.col("pos").alias("seq"),
            (sign == "+").alias("accept"),
            F.expr("substring(line, 2)").alias("pattern"),
        )
        .filter(valid_regex(F.col("pattern")))
    )


def parse_rewrites(texts: DataFrame, text: str = "text") -> DataFrame:
    """Pattern / substitution pairs of a rewrite document: ``seq, pattern, substitution``."""
    parsed = F.from_xml(F.col(text), "regex ARRAY<STRUCT<pattern:STRING,substitution:STRING>>")
    return texts.select(F.posexplode(parsed["regex"]).alias("seq", "r")).select(
        "seq", "r.pattern", F.coalesce("r.substitution", F.lit("")).alias("substitution")
    )


def parse_suffixes(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """Public-suffix text: ``suffix, kind`` with kind normal, wildcard or exception."""
    lines = numbered_lines(texts, doc, text)
    word = F.split(F.trim("line"), r"\s+")[0]
    kind = F.when(word.startswith("!"), "exception").when(word.startswith("*."), "wildcard").otherwise("normal")
    return (
        lines.filter((F.trim("line") != "") & ~F.trim("line").startswith("//"))
        .select(F.lower(F.regexp_replace(word, r"^(?:!|\*\.)", "")).alias("suffix"), kind.alias("kind"))
        .distinct()
    )


class RefreshingRules:
    """Rule table of a path, parsed again only when its files changed.

    Meant for ``foreachBatch``: call :meth:`get` per batch, the listing decides. With ``versions`` (a folder) every state of
    the rules is stored under its fingerprint, and a batch pins the one it used: a batch that is tried again, also by
    another process, gets the rules of its first try.
    """

    def __init__(self, spark: SparkSession, path: str, versions: str | None = None):
        self._spark, self._path, self._versions = spark, path, versions
        self._seen: str | None = None
        self._rules: DataFrame | None = None
        self.loads = 0

    def _fingerprint(self) -> str:
        files = (
            self._spark.read.format("binaryFile")
            .load(self._path)
            .agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("h"), F.count("*").alias("files"))
            .first()
        )
        return f"{files['files']}-{(files['h'] or 0) & (2**64 - 1):016x}"

    def _fs(self, path: str):
        p = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._spark._jsc.hadoopConfiguration()), p

    def _pinned(self, batch_id: int) -> str | None:
        """The version a batch used, from the name of its marker."""
        fs, p = self._fs(f"{self._versions}/batches")
        if not fs.exists(p):
            return None
        found = [f.getPath().getName().split("=", 1)[1] for f in fs.globStatus(self._fs(f"{self._versions}/batches/{batch_id}=*")[1]) or ()]
        return min(found, default=None)

    def get(self, batch_id: int | None = None) -> DataFrame:
        if self._versions is None or batch_id is None:
            return self._current(self._fingerprint())
        version = self._pinned(batch_id)
        if version is None:
            version = self._fingerprint()
            fs, done = self._fs(f"{self._versions}/rules={version}/_SUCCESS")
            if not fs.exists(done):
                read_deny_rules(self._spark, self._path).write.mode("overwrite").parquet(f"{self._versions}/rules={version}")
            fs.create(self._fs(f"{self._versions}/batches/{batch_id}={version}")[1], True).close()
        return self._current(version, f"{self._versions}/rules={version}")

    def _current(self, version: str, stored: str | None = None) -> DataFrame:
        if self._rules is None or version != self._seen:
            if self._rules is not None:
                self._rules.unpersist()
            self._rules = (self._spark.read.parquet(stored) if stored else read_deny_rules(self._spark, self._path)).persist()
            self._seen = version
            self.loads += 1
        return self._rules
