"""Secrets in texts: fixed forms, and strings that dictionary-primed compression can't shorten.

Fixed forms are key-value assignments, access key ids and long lower-case hexadecimal runs. Beyond them,
runs of 12 characters or more of A-Z, a-z, 0-9 and +/_.=- are candidates where they begin
within 80 characters of a sensitive word, or behind one in its statement (to a line's end, a semicolon or a
sentence's end), or in a private key block. zstandard, with a dictionary trained on identifiers (fixed words joined
as names are), compresses the text around the candidate without and with it, case folded. The added bytes
are held against the mean of ``DRAWS`` strings in its place whose characters are drawn at random from the same classes (letters, digits;
signs stay): names, words and repeats stay below, random strings come near or pass it. That ratio alone decides, for
candidates that could hold ``BITS`` bits; a word of one case needs a higher one.

Left out are strings broken by other signs, mail addresses, host names, dates, and what the fixed forms of personal data
(cards, phone numbers) take. Paths and the like, which begin with a slash or a dot and a slash, are measured part by part.

Each text is looked at whole, where it lies: no shuffle. Documents that hold none of the trigger words
are told apart for a whole batch at memory speed.

Cases: null or empty text has no span; repeated rows are each reported; long texts are searched whole
and in linear time; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlframe.llm.pii_bootstrap import base_spans as personal_forms
from crawlframe.llm.shared import text_of
from crawlframe.llm.spans import holders, text_bytes

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_HEX_RUN = 24
_IS_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Words that make their neighbourhood sensitive.
SENSITIVE = (*ASSIGN_WORDS, b"credential", b"bearer", b"authorization", b"private_key", b"private key", b"access_key", b"access key", b"passphrase")
_SENSITIVE = re.compile("|".join(w.decode() for w in SENSITIVE), re.IGNORECASE | re.ASCII)
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_STATEMENT_END = re.compile(r"[\n;]|[.!?](?=\s)")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY")
_HOST = re.compile(r"(?:[a-z0-9-]+\.)+[a-z]{2,}")
_DATE = re.compile(r"[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}(?:[T_-][0-9.-]*Z?)?")
_WORD = re.compile(r"[A-Z]?[a-z]+")
_PART = re.compile(r"[^/]+")
#: Characters around a sensitive word in which strings are candidates, and around a candidate that prime its measure.
NEAR, AROUND = 80, 256
#: Least added bytes, as a part of what random characters add; that of a word of one case; strings drawn for that.
DRAWS = 6
NOVELTY, WORD_NOVELTY = 0.88, 1.0
#: Least bits that as many random characters would take.
BITS = 64
#: Size of the trained dictionary, the samples it is trained on and the names in each.
DICTIONARY_BYTES, SAMPLES, SAMPLE_NAMES = 112_640, 4000, 60
#: Words of code and configuration that make a name rather than a secret.
IDENTIFIERS = """
access account action address admin alias allow api app application argument array async auth authorization backend base64 bearer bool
boolean bucket buffer build bytes cache call callback category certificate char charset class client cloud code column command comment
commit common component config configuration connection const constructor container content context controller cookie copy count create
credential current cursor data database date datetime debug default delete description developer device directory disable document domain
double element email enable encoding endpoint environment error event example exception expire export false field file filename filter
float folder format forward function gateway generate get global group handler hash header host hostname http https identifier image
import include index init input insert instance integer interface internal item iterator json key label language length level library
limit link list listener load local localhost location lock log login logout main manager map master max member memory message metadata
method min mode model module monitor name namespace network node null number object offset open option order origin output owner package
page parameter parent parse passphrase passwd password path payload pending permission platform plugin policy pool port position post
prefix primary private process production profile project property protocol provider proxy public put query queue random read record
redirect refresh region register release remote remove repository request required reset resource response result return role root route
rule runtime sample schema scope script search secret section select sequence server service session set setting shared signature size
socket source stack start state static status storage store stream string struct submit subject subscription success suffix summary
system table tag target task template temporary tenant test text thread time timeout timestamp title token topic transaction transfer
true type undefined unique update upload url user username utility uuid validate value variable vendor version view void volume warning
webhook window worker workflow write yaml
""".split()

_FIXED = frozenset(IDENTIFIERS)
#: Prose in front of what is measured: letters enough that the dictionary's code for letters is used.
_LEAD = """We went down along the river before anyone else was awake, and what the morning brought us there was nothing but fog. Nobody
had seen the two of them since early in the week; so we asked at each house on the way, but all who answered knew as little as we did.
"""


@lru_cache(1)
def identifier_dictionary() -> bytes:
    """A dictionary trained on names made of the fixed words; the same at every call."""
    import zstandard

    rnd = random.Random(9)

    def name() -> str:
        own = rnd.choice(("_", "-", "", "", "/", ".")).join(rnd.choices(IDENTIFIERS, k=rnd.randrange(1, 4)))
        return own + str(rnd.randrange(1, 100)) if rnd.random() < 0.03 else own

    samples = [" ".join(name() for _ in range(SAMPLE_NAMES)).encode() for _ in range(SAMPLES)]
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8, level=6).as_bytes()


def _same_class(c: str) -> str:
    return string.ascii_lowercase if c.isalpha() else string.digits if c.isdigit() else c


class Novelty:
    """Added compressed bytes of a string behind the text around it, as a part of what random characters of its classes add there."""

    def __init__(self, dictionary: bytes | None = None):
        import zstandard

        own = zstandard.ZstdCompressionDict(dictionary or identifier_dictionary(), dict_type=zstandard.DICT_TYPE_FULLDICT)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.zstd = zstandard.ZstdCompressor(level=6, dict_data=own, **options)

    @staticmethod
    def random_bits(own: str) -> float:
        kinds = 26 * any(map(str.isalpha, own)) + 10 * any(map(str.isdigit, own)) + len({c for c in own if not c.isalnum()})
        return len(own) * math.log2(max(2, kinds))

    def of(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        # the lines in front keep what a short text costs by itself out of the difference
        around = (_LEAD + after + "\n" + before).lower().encode("utf-8", "surrogatepass")
        own = text[start:end].lower()
        rnd = random.Random(own)
        drawn = ["".join(map(rnd.choice, map(_same_class, own))) for _ in range(DRAWS)]
        bare, cost, *costs = (len(self.zstd.compress(around + x.encode())) for x in ("", own, *drawn))
        return DRAWS * (cost - bare) / max(1, sum(costs) - DRAWS * bare)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed forms of a text, in code points."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def sensitive_regions(text: str) -> list[tuple[int, int]]:
    """Neighbourhoods of sensitive words, statements behind them and key blocks, by their starts, with ends that don't fall."""
    words = [(m.start(), m.end()) for m in _SENSITIVE.finditer(text)]
    if not words:
        return []
    ends = [m.start() for m in _STATEMENT_END.finditer(text)] + [len(text)]
    regions = [(a - NEAR, max(b + NEAR, ends[bisect_left(ends, b)])) for a, b in words]
    done = 0
    for m in _KEY_BLOCK.finditer(text):
        if m.start() >= done:
            done = text.find("-----END", m.end())
            done = len(text) if done < 0 else done
            regions.append((m.start(), done))
    out, last = [], 0
    for a, b in sorted(regions):
        last = max(last, b)
        out.append((a, last))
    return out


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs without dots at their ends; of a path, its parts."""
    for m in _RUN.finditer(text):
        start, end = m.span()
        path = text.startswith(("/", "./", "../", "-/"), start)
        for a, b in [p.span() for p in _PART.finditer(text, start, end)] if path else [(start, end)]:
            own = text[a:b].strip(".")
            a += len(text[a:b]) - len(text[a:b].lstrip("."))
            if len(own) >= 12:
                yield a, a + len(own)


def novel_spans(text: str, known: list[tuple[str, int, int]], novelty: Novelty) -> list[tuple[str, int, int]]:
    """Candidates in sensitive neighbourhoods that overlap no known span and can't be compressed."""
    found: list[tuple[str, int, int]] = []
    words = sensitive_regions(text)
    if not words:
        return found
    taken = sorted((a, b) for _, a, b in known + personal_forms(text))
    at = past = 0
    for start, end in _candidates(text):
        own = text[start:end]
        while at < len(words) and words[at][1] < start:
            at += 1
        while past < len(taken) and taken[past][1] <= start:
            past += 1
        if at == len(words):
            break
        if words[at][0] > start or (past < len(taken) and taken[past][0] < end):
            continue
        if text[start - 1 : start] == "@" or text[end : end + 1] == "@" or _HOST.fullmatch(own) or _DATE.fullmatch(own) or own.lower() in _FIXED:
            continue
        if novelty.random_bits(own.lower()) >= BITS and novelty.of(text, start, end) >= (WORD_NOVELTY if _WORD.fullmatch(own) else NOVELTY):
            found.append(("novel", start, end))
    return found


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end in code points) of every row of ``docs`` (doc_id, text)."""

    dictionary = docs.sparkSession.sparkContext.broadcast(identifier_dictionary())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary.value)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                column = part.column(1)
                data, offsets = text_bytes(column)
                rows = holders(data.translate(_LOWER), offsets, SENSITIVE)
                rows |= holders(data, offsets, (b"AKIA",)) | holders(data.translate(_IS_HEX), offsets, (b"h" * _HEX_RUN,))
                spans: list[list] = [[] for _ in range(part.num_rows)]
                for i in rows:
                    text = column[i].as_py()
                    own = base_spans(text)
                    own += novel_spans(text, own, novelty)
                    spans[i] = [{"kind": k, "start": s, "end": e} for k, s, e in sorted(own, key=lambda x: (x[1], KINDS.index(x[0])))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")
