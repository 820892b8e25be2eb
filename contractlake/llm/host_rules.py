"""Quality rules by host: failures added up per host, rates shrunk by a beta prior fitted to all
hosts, verdicts joined back to the documents."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contractlake.llm.common import map_batches, staged

WORD = re.compile(r"[^ \t-\r]+")
SYMBOL = re.compile(r"[#*$%&|<>]")

FEATURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[str]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : len(windows) + shift] |= again
    return int(inside.sum())


def text_features(text: str | None) -> tuple[int, ...]:
    """The columns of ``FEATURES``; all 0 for null and for a text without words."""
    text = text or ""
    words = WORD.findall(text)
    seen: set[str] = set()
    lines = repeated = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            repeated += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(SYMBOL.findall(text)), lines, repeated, repeat_words(words),
    )


def document_features(documents: DataFrame) -> DataFrame:
    """All columns but ``text`` of a frame, with the counts of its ``text``."""
    kept = [name for name in documents.columns if name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = [text_features(text.as_py()) for text in batch.column("text")]
            counts = np.array(rows, np.int64).reshape(len(rows), 6)
            yield {n: batch.column(n) for n in kept} | {
                n: counts[:, i] for i, n in enumerate(f.split()[0] for f in FEATURES.split(", "))
            }

    head = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes if n != "text")
    return map_batches(documents, work, f"{head}, {FEATURES}")


@dataclass(frozen=True)
class HostRules:
    """When a document breaks a rule, and which shrunk rate of it a host may have."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    max_rate: float = 0.5

    def broken(self) -> dict[str, Column]:
        c = F.col
        return {
            "short": c("n_words") < self.min_words,
            "repeats": 100 * c("n_repeat_words") > self.max_repeat_percent * c("n_words"),
            "symbols": 100 * c("n_symbols") > self.max_symbol_percent * c("n_words"),
            "dup_lines": 100 * c("n_dup_lines") > self.max_dup_line_percent * c("n_lines"),
        }


def beta_prior(documents: int, failed: int, hosts: int, spread: float) -> tuple[float, float]:
    """Alpha and beta by moments. ``spread`` is the sum over hosts of n * (rate - mean)**2.

    What the hosts' rates differ by beyond the draw of their documents is the variance of the
    beta distribution. Without such a difference the prior is strong: all hosts have the mean.
    """
    mean = (failed + 0.5) / (documents + 1)
    drawn = mean * (1 - mean)
    between = (spread - (hosts - 1) * drawn) / max(documents, 1)
    strength = min(max(drawn / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def host_verdicts(features: DataFrame, rules: HostRules) -> DataFrame:
    """Per ``host``: ``host_documents``, a shrunk rate per rule, ``host_kept``.

    ``features`` has ``host`` and the counts. A host goes when the shrunk rate of any rule is
    above the limit. Rows without a host are left out. Two numbers per rule reach the driver.
    """
    broken = rules.broken()
    by_host = (
        features.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("host_documents"),
            *[F.count_if(test).alias(f"{name}_failed") for name, test in broken.items()],
        )
    )
    by_host = staged(by_host, "hosts")
    n = F.col("host_documents")
    total = by_host.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("hosts"),
        *[F.coalesce(F.sum(f"{name}_failed"), F.lit(0)).alias(name) for name in broken],
    ).first()
    means = {name: (total[name] + 0.5) / (total.n + 1) for name in broken}
    spread = by_host.agg(
        *[
            F.coalesce(F.sum(n * F.pow(F.col(f"{name}_failed") / n - mean, F.lit(2))), F.lit(0.0)).alias(name)
            for name, mean in means.items()
        ]
    ).first()
    rates = {}
    for name in broken:
        alpha, beta = beta_prior(total.n, total[name], total.hosts, spread[name])
        rates[name] = (F.col(f"{name}_failed") + alpha) / (n + alpha + beta)
    worst = F.greatest(*rates.values())
    return by_host.select(
        "host", "host_documents", *[r.alias(f"{name}_rate") for name, r in rates.items()],
        (worst <= rules.max_rate).alias("host_kept"),
    )


def judge_documents(
    documents: DataFrame, key: str = "doc_id", host: str = "source", rules: HostRules | None = None
) -> DataFrame:
    """One row per document: ``key``, ``host``, the counts, ``base_failed``, the host's size and
    rates, ``kept``.

    A document goes if it is short or made of repeats itself, or if its host's verdict is bad.
    Null texts count as empty, documents without a host are judged by themselves, repeated rows
    each stay and count, other columns are not read. The texts are read once; a host with a
    third of all documents is one partial sum per task, and the join back is on a table of hosts.
    """
    rules = rules or HostRules()
    named = documents.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{host}`").alias("host"), F.col("text").alias("text")
    )
    features = staged(document_features(named), "features")
    judged = features.join(host_verdicts(features, rules), "host", "left")
    broken = rules.broken()
    base = broken["short"] | broken["repeats"]
    kept = ~base & F.coalesce("host_kept", F.lit(True))
    return judged.withColumn("base_failed", base).withColumn("kept", kept).withColumnRenamed("key", key)
