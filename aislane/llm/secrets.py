"""Secret scans: fixed patterns, and strings that a dictionary-primed zstandard coder finds new.

The patterns report assignments, access keys and long hexadecimal strings. Beyond them, a *candidate* is a run of 16 or
more characters of ``[A-Za-z0-9+/_=-]`` with letters and digits in it. It stands in a *sensitive context* if one
of the context words occurs in the 48 characters before it. Its novelty is marginal: the bytes that a
zstandard frame of context and candidate takes beyond a frame of the context alone, both primed with a dictionary of
identifiers, against the candidate's length. The dictionary has a few words of code and, learned from all texts, the at most ``LEARNED``
most frequent words without digits that follow many different words; copies of a text add none, so a key that
many copies hold is not learned. The surrounding code is in the frames themselves. Words, identifiers and
repeats cost few bytes; random keys cost three quarters of a byte per character or more and are reported as kind ``novel``.
Copies of the candidate, or of a long part of it with digits, are taken out of the context first, so a key that stands twice is judged like one
that stands once, and reported at each place in a sensitive context.

Defined results: a null text is empty and has no spans. Words of one frequency are all learned or, where they would exceed the bound, none of them. Spans are in code points, end exclusive. Of a candidate that
overlaps patterns' spans only what they leave over counts: letters and digits that go on beside an access key or a hexadecimal string without a break are
reported with it, the rest is judged like a candidate. Repeated rows are scanned one by one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislane.llm.sparse import most_frequent

# The patterns, and how long a match has to be.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
CONTEXT = re.compile(
    r"pass|pwd|secret|token|api|key|auth|bearer|credential|private|signature|session|cookie|login|akia", re.IGNORECASE | re.ASCII
)
CONTEXT_REACH = 48
AROUND = 256
# Where a candidate may be put together of a name and a key, first on one side of ``=`` only.
JOINTS = (re.compile("="), re.compile("[=/_-]"))
LEAST_PART = 16
RUN_ON, RUN_UP = re.compile(r"[A-Za-z0-9]+"), re.compile(r"[A-Za-z0-9]+\Z")
NOVELTY = 0.7

# What is learned from the corpus: whole words of letters and ``_``, at most so many (so 84 KB at most are broadcast).
WORD = re.compile(r"(?<![A-Za-z0-9_])[A-Za-z_]{4,40}(?![A-Za-z0-9_])")
LEARNED = 2048
# Words before a word are told apart by 64 buckets; a word that is learned has met this many of them.
BUCKETS, LEAST_BUCKETS = 64, 16
COUNT_WORDS = 300_000

# Words of code and configuration that a coder should know already.
IDENTIFIERS = """
public private protected static final const class struct interface function return import export default package
include define string integer boolean double float char void null none true false self this super async await
request response handler controller service client server session cookie header authorization bearer basic
username password passwd secret token access refresh api_key apikey client_id client_secret private_key public_key
certificate signature encrypt decrypt encode decode base64 sha256 algorithm connection database host port localhost
configuration environment variable settings options parameters arguments version description https http www com org
BEGIN RSA PRIVATE KEY END CERTIFICATE ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 0123456789abcdef
getElementById addEventListener createElement toString valueOf hasOwnProperty undefined constructor prototype
""".encode()


class Novelty:
    """Marginal compressed bytes of a candidate, given the text around it and words to know, the most frequent last."""

    def __init__(self, learned: tuple[str, ...] = ()):
        words = IDENTIFIERS + "\n".join(learned).encode()
        known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.coder = zstandard.ZstdCompressor(level=9, dict_data=known, **options)

    def ratio(self, around: str, candidate: str) -> float:
        base = around.encode()
        alone = len(self.coder.compress(base))
        both = len(self.coder.compress(base + b"\n" + candidate.encode()))
        return (both - alone) / len(candidate)


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _without(text: str, copies: re.Pattern, begin: int, end: int, reach: tuple[int, int]) -> str:
    """``text[begin:end]`` without copies that lie within ``reach``, which is wider."""
    kept, at = [], begin
    for match in copies.finditer(text, *reach):
        kept.append(text[at : min(end, max(at, match.start()))])
        at = min(end, max(at, match.end()))
    return "".join([*kept, text[at:end]])


def _around(text: str, begin: int, end: int) -> str:
    """The text on both sides of a candidate without its copies."""
    candidate = text[begin:end]
    parts = {p for joint in JOINTS for p in joint.split(candidate) if len(p) >= LEAST_PART and any(c.isdigit() for c in p)}
    copies = re.compile("|".join(map(re.escape, sorted({candidate, *parts}, key=lambda p: (-len(p), p)))))
    first, last = max(0, begin - AROUND), min(len(text), end + AROUND)
    wider = max(0, first - len(candidate)), min(len(text), last + len(candidate))
    before = _without(text, copies, first, begin, (wider[0], begin))
    return before + _without(text, copies, end, last, (end, wider[1]))


def _left_over(text: str, begin: int, end: int, taken: list[tuple[int, int, str]]) -> tuple[list, list]:
    """What spans leave of a candidate: runs that belong to a span beside them, and other parts."""
    runs, parts, at, kind = [], [], begin, None
    over = sorted(s for s in taken if s[0] < end and begin < s[1])
    for a, b, following in [*over, (end, end, None)]:
        first, last = at, max(at, a)
        if kind in ("access", "hex") and (match := RUN_ON.match(text, first, last)):
            first = match.end()
            runs.append(match.span())
        if following in ("access", "hex") and (match := RUN_UP.search(text[first:last])):
            runs.append((first + match.start(), last))
            last = first + match.start()
        if first < last:
            parts.append((first, last))
        if b >= at:
            at, kind = b, following
    return runs, parts


def novel_spans(text: str, taken: list[tuple[int, int, str]], novelty: Novelty) -> list[tuple[int, int, str]]:
    """Candidates in a sensitive context that the primed coder can't shorten."""
    found = []
    for match in CANDIDATE.finditer(text):
        candidate = match.group()
        if not (any(c.isdigit() for c in candidate) and any(c.isalpha() for c in candidate)):
            continue
        if not CONTEXT.search(text, max(0, match.start() - CONTEXT_REACH), match.start()):
            continue
        runs, parts = _left_over(text, *match.span(), taken)
        found += [(begin, end, "novel") for begin, end in runs]
        for begin, end in parts:
            own = text[begin:end]
            if len(own) < LEAST_PART or not (any(c.isdigit() for c in own) and any(c.isalpha() for c in own)):
                continue
            if novelty.ratio(_around(text, begin, end), own) >= NOVELTY:
                found.append((begin, end, "novel"))
    return sorted(found)


def word_contexts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``word, n, buckets``: how often each word without digits stands in all texts, and after how many buckets of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: Counter[str] = Counter()
        after: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            # A mask of 64 bits as a signed number.
            masks = [m - (1 << BUCKETS) if m >> (BUCKETS - 1) else m for m in map(after.get, times)]
            columns = (pa.array(list(times), pa.string()), pa.array(list(times.values()), pa.int64()), pa.array(masks, pa.int64()))
            times.clear()
            after.clear()
            return pa.RecordBatch.from_arrays(list(columns), ["word", "n", "mask"])

        for batch in batches:
            pairs: set[tuple[str, str]] = set()
            for text in batch.column(0).to_pylist():
                found = WORD.findall(text)
                times.update(found)
                pairs.update(zip(["", *found], found, strict=False))
            bits = {before: 1 << zlib.crc32(before.encode()) % BUCKETS for before in {p[0] for p in pairs}}
            for before, word in pairs:
                after[word] = after.get(word, 0) | bits[before]
            if len(times) >= COUNT_WORDS:
                yield out()
        if times:
            yield out()

    texts = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    counted = texts.mapInArrow(count, "word string, n long, mask long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("mask")).alias("buckets"))


def learned_identifiers(docs: DataFrame, text_column: str = "text", most: int = LEARNED) -> tuple[str, ...]:
    """At most ``most`` words for the coder's dictionary, the most frequent last."""
    counted = word_contexts(docs, text_column).where(F.col("buckets") >= LEAST_BUCKETS).persist(StorageLevel.DISK_ONLY)
    chosen = most_frequent(counted, "n", most).select("n", "word").collect()
    counted.unpersist()
    return tuple(r["word"] for r in sorted(chosen))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per document: ``doc_id, spans array<struct<kind, begin, end, base>>``, in order."""
    shared = docs.sparkSession.sparkContext.broadcast(learned_identifiers(docs, text_column))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(shared.value)
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        )
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = pattern_spans(text)
                every = in_order(base + novel_spans(text, base, novelty))
                out.append([{"kind": k, "begin": a, "end": b, "base": k != "novel"} for a, b, k in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(scan, "doc_id long, spans array<struct<kind:string,begin:int,end:int,base:boolean>>")


def span_text(spans):
    """``kind:begin:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def masked(docs: DataFrame, text_column: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced; other columns as they were, null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(learned_identifiers(docs, text_column))
    novelty = []

    def replace(text: str | None) -> str | None:
        if text is None:
            return None
        if not novelty:
            novelty.append(Novelty(shared.value))
        base = pattern_spans(text)
        parts, at = [], 0
        for begin, end, _ in in_order(base + novel_spans(text, base, novelty[0])):
            if begin >= at:
                parts += [text[at:begin], mask]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def batchwise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(replace)

    return docs.withColumn(text_column, F.pandas_udf(batchwise, "string")(F.col(text_column).cast("string")))
