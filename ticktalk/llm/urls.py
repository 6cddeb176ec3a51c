"""URL filters: rules by host and path, and for the rest naive Bayes over segmented host words and path tokens."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticktalk.llm.common import query, table
from ticktalk.session import settle

#: Fixed values: (action, host and path prefix).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Number of feature buckets of the classifier, and words that the segmenter knows: they bound what travels with the tasks.
BUCKETS, VOCABULARY = 1 << 18, 50_000
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's; null if none fits."""
    tried = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        tried.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*tried)


class Segmenter:
    """Most probable split of a name into known words, by Viterbi over unigrams. A letter outside any known word costs more
    than the rarest word. Splits of names are kept while they are few enough."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) or 1
        self.log = {w: math.log(n / total) for w, n in counts.items()}
        self.longest = max(map(len, counts), default=1)
        self.unknown = -math.log(total) - 3
        self.kept: dict[str, list[str]] = {}

    def split(self, name: str) -> list[str]:
        if name in self.kept:
            return self.kept[name]
        n = len(name)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - self.longest), end):
                word = name[begin:end]
                score = self.log.get(word)
                if score is None:
                    if end - begin > 1:
                        continue
                    score = self.unknown
                if best[begin] + score > best[end]:
                    best[end], back[end] = best[begin] + score, begin
        words = []
        while n:
            words.append(name[back[n] : n])
            n = back[n]
        if len(self.kept) > 100_000:
            self.kept.clear()
        self.kept[name] = words[::-1]
        return words[::-1]


def tokens(host: str, path: str, segmenter: Segmenter) -> list[str]:
    """Words of the host's labels, and path parts; a number is one token for its number of digits."""
    out = []
    for label in host.split("."):
        for part in re.findall(r"[^\W\d_]+|\d+", label):
            out += ["h:" + w for w in segmenter.split(part)] if not part[0].isdigit() else [f"h#{len(part)}"]
    for part in re.findall(r"[^\W\d_]+|\d+", path.translate(LOWER)):
        out.append(f"p#{len(part)}" if part[0].isdigit() else "p:" + part)
    return out


def buckets(host: str, path: str, segmenter: Segmenter) -> list[int]:
    return [zlib.crc32(t.encode()) % BUCKETS for t in tokens(host, path, segmenter)]


def word_counts(texts: DataFrame, column: str, most: int = VOCABULARY) -> dict[str, int]:
    """The most frequent lower-case words of all texts, runs of letters as in ``tokens``, counted over all rows: exactly ``most`` of them if there
    are as many, the first in order of code points where counts are equal."""
    words = texts.select(F.explode(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counts = settle(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    # Whole counts while they fit, from the number of words of each count; of the count that doesn't, the first words.
    room, cut = most, None
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if r["words"] > room:
            cut = r["n"]
            break
        room -= r["words"]
    whole = counts if cut is None else counts.where(F.col("n") > cut)
    found = {r["word"]: r["n"] for r in whole.collect()}
    if cut is not None and room:
        found |= {r["word"]: r["n"] for r in counts.where(F.col("n") == cut).orderBy("word").limit(room).collect()}
    return found


def learn(rows: DataFrame, words: dict[str, int], smoothing: float = 1.0) -> tuple[np.ndarray, float]:
    """(log odds of block per bucket, log prior odds) from rows ``host, path, verdict``. Multinomial with added ``smoothing``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(words)
        total = np.zeros((2, BUCKETS + 1), np.int64)  # the last bucket counts pages
        for batch in batches:
            for host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "verdict"))):
                for b in buckets(host, path, segmenter):
                    total[int(verdict == "block"), b] += 1
                total[int(verdict == "block"), BUCKETS] += 1
        k, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(b, pa.int64()), pa.array(total[k, b], pa.int64())], ["k", "b", "n"])

    sums = rows.select("host", "path", "verdict").mapInArrow(count, "k long, b long, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((2, BUCKETS + 1))
    total[sums.k, sums.b] = sums.n
    pages, total = total[:, BUCKETS] + smoothing, total[:, :BUCKETS]
    used = total.sum(0) > 0
    share = np.log(total + smoothing) - np.log(total.sum(1, keepdims=True) + smoothing * max(1, used.sum()))
    return np.where(used, share[1] - share[0], 0.0).astype(np.float32), float(np.log(pages[1] / pages[0]))


def judge(pages: DataFrame, words: dict[str, int], rules: tuple[tuple[str, str], ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of each url.

    A fitting rule decides. Other urls go to naive Bayes, learned from the urls that rules decide: ``score`` is the
    probability of block, and 0.5 or less allows. Host names are segmented by ``words`` (counts of a corpus).

    Null url or one without ``://``: host and path empty, no rule, judged by the share of blocked urls alone. Without any
    page that a rule decides the score is 0.5. Null ids, repeated rows and other columns change nothing. Empty table: no rows.
    Rules travel in the plan, so this suits lists of up to some thousands."""
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    action = F.create_map(*[F.lit(x) for kind, rule in rules for x in (rule, kind)])
    parsed = parsed.withColumn("verdict", F.when(F.col("rule").isNotNull(), F.element_at(action, F.col("rule"))))
    odds, prior = learn(parsed.where("rule IS NOT NULL"), words)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(words)
        for batch in batches:
            out = []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                x = prior + float(odds[buckets(host, path, segmenter)].sum(dtype=float))
                out.append(1 / (1 + math.exp(-x)) if x > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "score"])

    kind = dict(pages.dtypes)[id_col]
    scored = parsed.mapInArrow(score, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")))


@query()
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return judge(pages, word_counts(pages, "html"))
