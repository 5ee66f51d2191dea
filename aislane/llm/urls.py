"""URL filter: rules on host and path, and for the rest naive Bayes on words that hosts are made of.

The longest rule that fits decides: it fits its host and all subdomains if the path starts with the rule's. URLs that no rule
fits go to the method. A host's labels are split into words by Viterbi over unigram probabilities, counted in all pages' visible
text. Multinomial naive Bayes scores these words and the path's tokens; it learns from the URLs that the rules decide, with one added
to every count, so a token it hasn't seen has the odds of the classes' sizes.

Nothing of this has a fixed size. Words and tokens are counted exactly, in tables. A label meets the words it may
hold by a join on its substrings of up to ``LONGEST_WORD`` letters (a longer word is never split off); the at most 702 words of one or two letters, which
nearly every label holds, are broadcast instead. Labels, hosts and paths are worked out once each, however many pages have them, and the pages
fetch their sums by joins that Spark splits where one key is large. Odds are added as whole billionths, so no order of adding matters.

Defined results: a null URL or one without ``://`` has an empty host and path, and like any URL without tokens gets the more common verdict
of the learned classes (allow on a tie). Without any decided URL every verdict of the method is allow. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import staged

LONGEST_WORD = 24
SHORT_WORD = 2
ALLOW, BLOCK = "allow", "block"
BILLION = 1_000_000_000
_CANDIDATES = 50_000

# A-Z and a-z.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = r"[\p{L}\p{N}]+"
_LABEL_PART = r"[a-z]+|[0-9]+|[^a-z0-9.\-]+"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The rule that decides, as text, and its verdict; both null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        name, verdict = F.when(fits, str(rule)).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def lexicon(pages: DataFrame, html_column: str = "html") -> tuple[DataFrame, int]:
    """``word, n`` of the pages' visible text, words of up to ``LONGEST_WORD`` letters, and how many words there are in all."""
    text = F.regexp_replace(F.coalesce(F.col(html_column).cast("string"), F.lit("")), r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    found = pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]+"), F.lit(0))).alias("word"))
    counts = staged(found.groupBy("word").agg(F.count("*").alias("n")), "lexicon")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.length("word") <= LONGEST_WORD), total


class Segmenter:
    """Viterbi over unigrams; an unknown word is ten times less likely with every letter."""

    def __init__(self, counts: dict[str, int], total: int):
        self.total = math.log(max(total, 1))
        self.cost = {w: self.total - math.log(n) for w, n in counts.items()}

    def word_cost(self, word: str) -> float:
        found = self.cost.get(word)
        return found if found is not None else self.total + (len(word) - 1) * math.log(10)

    def __call__(self, letters: str) -> list[str]:
        best, cut = [0.0], [0]
        for end in range(1, len(letters) + 1):
            options = [
                (best[begin] + self.word_cost(letters[begin:end]), begin)
                for begin in range(max(0, end - LONGEST_WORD), end)
            ]
            cost, begin = min(options)
            best.append(cost)
            cut.append(begin)
        words, end = [], len(letters)
        while end:
            words.append(letters[cut[end] : end])
            end = cut[end]
        return words[::-1]


def segments(letters: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``letters, words``: each run of letters (once each) with its likeliest words."""
    short = {r["word"]: r["n"] for r in counts.where(F.length("word") <= SHORT_WORD).collect()}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, parts = [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(whole, pa.string()), pa.array(parts, pa.string())], ["letters", "word"])
            whole.clear()
            parts.clear()
            return made

        for batch in batches:
            for run in batch.column(0).to_pylist():
                sizes = range(SHORT_WORD + 1, min(LONGEST_WORD, len(run)) + 1)
                found = sorted({run[i : i + size] for size in sizes for i in range(len(run) - size + 1)})
                whole += [run] * len(found)
                parts += found
                if len(parts) >= _CANDIDATES:
                    yield out()
        yield out()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for run, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known = {w: n for w, n in short.items() if w in run} | {m["word"]: m["n"] for m in own or ()}
                words.append(Segmenter(known, total)(run))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["letters", "words"])

    held = letters.mapInArrow(pieces, "letters string, word string").join(counts, "word")
    held = held.groupBy("letters").agg(F.collect_list(F.struct("word", "n")).alias("held"))
    return letters.join(held, "letters", "left").select("letters", "held").mapInArrow(split, "letters string, words array<string>")


def host_tokens(hosts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """``host, token`` for every word and other part of the distinct ``hosts``, repeats included."""
    parts = hosts.select("host", F.explode(F.regexp_extract_all("host", F.lit(_LABEL_PART), F.lit(0))).alias("letters"))
    runs = F.col("letters").rlike("^[a-z]+$")
    words = segments(parts.where(runs).select("letters").distinct(), counts, total)
    split = parts.where(runs).join(words, "letters").select("host", F.explode("words").alias("token"))
    whole = split.unionByName(parts.where(~runs).select("host", F.col("letters").alias("token")))
    return whole.select("host", F.concat(F.lit("h:"), "token").alias("token"))


def path_tokens(paths: DataFrame) -> DataFrame:
    """``path, token`` for every token of the distinct ``paths``, repeats included."""
    found = F.regexp_extract_all(F.lower("path"), F.lit(_TOKEN), F.lit(0))
    return paths.select("path", F.explode(found).alias("token")).select("path", F.concat(F.lit("p:"), "token").alias("token"))


@dataclass(frozen=True)
class Odds:
    """Log-odds for block in billionths: of the classes, and of a token that no decided URL has."""

    prior: int
    unseen: int

    @classmethod
    def of(cls, urls: tuple[int, int], tokens: tuple[int, int], distinct: int) -> Odds:
        size = max(1, distinct)
        prior = math.log(urls[1] + 1) - math.log(urls[0] + 1) if sum(urls) else 0.0
        return cls(round(prior * BILLION), round((math.log(tokens[0] + size) - math.log(tokens[1] + size)) * BILLION))

    def token(self, allowed: Column, blocked: Column) -> Column:
        """Of a token by its counts in URLs allowed and blocked."""
        return F.round((F.log(blocked + 1) - F.log(allowed + 1)) * BILLION).cast("long") + self.unseen


def _learn(decided: DataFrame, of_host: DataFrame, of_path: DataFrame) -> tuple[Odds, DataFrame]:
    """The odds, and ``token, odds`` of all tokens of the URLs that rules decide."""
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in (ALLOW, BLOCK)]
    of_class = decided.agg(*counts).first()
    held = [
        decided.groupBy(key).agg(*counts).join(found, key).select("token", ALLOW, BLOCK)
        for key, found in (("host", of_host), ("path", of_path))
    ]
    summed = held[0].unionByName(held[1]).groupBy("token").agg(*[F.sum(v).alias(v) for v in (ALLOW, BLOCK)])
    summed = staged(summed, "tokens")
    whole = summed.agg(F.count("*"), *[F.coalesce(F.sum(v), F.lit(0)) for v in (ALLOW, BLOCK)]).first()
    odds = Odds.of(tuple(of_class), tuple(whole[1:]), whole[0])
    return odds, summed.select("token", odds.token(F.col(ALLOW), F.col(BLOCK)).alias("odds"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_odds`` for every page; ``block_odds`` is the method's log-odds."""
    host, path = host_and_path(F.col(url_column))
    parts = pages.select(F.col(id_column).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "verdict": verdict})
    parts = staged(parts, "urls")
    counts, total = lexicon(pages, html_column)
    of_host = staged(host_tokens(parts.select("host").distinct(), counts, total), "host-tokens")
    of_path = path_tokens(parts.select("path").distinct())
    odds, of_token = _learn(parts.where("verdict is not null"), of_host, of_path)

    def added(found: DataFrame, key: str) -> DataFrame:
        # A token is met once for each host or path, after its repeats in it are counted.
        repeats = found.groupBy(key, "token").agg(F.count("*").alias("n"))
        met = repeats.join(of_token, "token", "left").withColumn("odds", F.coalesce("odds", F.lit(odds.unseen)))
        return met.groupBy(key).agg(F.sum(F.col("n") * F.col("odds")).alias(f"_{key}"))

    scored = parts.join(added(of_host, "host"), "host", "left").join(added(of_path, "path"), "path", "left")
    whole = F.lit(odds.prior) + F.coalesce("_host", F.lit(0)) + F.coalesce("_path", F.lit(0))
    decided = F.coalesce("verdict", F.when(whole > 0, BLOCK).otherwise(ALLOW))
    return scored.select("page_id", "host", "path", "rule", decided.alias("verdict"), (whole / BILLION).alias("block_odds"))
