"""URL rules and a URL classifier: logistic regression on hashed character n-grams of host and path.

Rules decide first: a rule names a host and the start of a path, fits the host and its subdomains, and the longest rule
that fits wins. The classifier decides the rest. It learns from a small labelled table of URLs on the driver, with full
gradients in a fixed order, so that its weights are the same on every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.words import FOLD, mix, text_buffers

#: Weights of the model, a power of two: bounds what is broadcast.
DIMENSIONS = 1 << 15
LENGTHS = (3, 4, 5)
#: The labelled table may have so many rows; it is trained on the driver.
MOST_LABELLED = 100_000

#: Fixed rules: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Words of unwanted and of ordinary host names, from which the labelled table is built.
UNWANTED = "casino bets poker jackpot slots pills pharma viagra loans payday adult xxx escort lottery replica win free cheap".split()
ORDINARY = (
    "library museum school news weather garden kitchen travel music science history forum wiki blog review sports health"
    " council archive market theatre gallery cycling books radio chess maths rivers trains bridge"
).split()


def labelled_urls() -> list[tuple[str, int]]:
    """Url and label (1: block): pairs of words joined by a hyphen, and single words, on a few sites and paths."""
    rows = []
    sites = ("example.com", "example.net", "example.org")
    places = ("/en/{n}", "/de/{n}.html", "/fr/{n}/", "/es/{n}?page=2", "/{n}#top", "")
    leads = ("", "www.", "m.", "blog.")
    for label, words in ((1, UNWANTED), (0, ORDINARY)):
        for n, word in enumerate(words):
            other = words[(n * 7 + 3) % len(words)]
            hosts = (f"{word}-{other}", f"{other}{word}", word)
            for k, host in enumerate(hosts):
                m = 3 * n + k
                place = places[m % len(places)].format(n=1000 + 37 * m)
                rows.append((f"http://{leads[m % len(leads)]}{host}.{sites[m % len(sites)]}{place}", label))
    # Invented names, as hosts of pages without any of these words have.
    bits = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    for n in range(60):
        host = "".join(bits[(n * k * k + 5 * k + n) % len(bits)] for k in range(1, 4))
        rows.append((f"https://{leads[n % len(leads)]}{host}.{sites[n % len(sites)]}{places[n % len(places)].format(n=1000 + 53 * n)}", 0))
    return rows


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    has = url.isNotNull() & url.contains("://")
    after = F.expr("substring(_u, instr(_u, '://') + 3)")
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(has, F.translate(host, upper, lower)).otherwise(""), F.when(has, path).otherwise("")


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, or null. ``rules`` is a short list, part of the plan."""
    best = F.lit(None)
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        chosen = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, chosen).otherwise(best)
    return best


def features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and hashed n-gram numbers of every host and path; both ends of each are marked."""
    rows, grams = [], []
    for salt, column in enumerate((hosts, paths)):
        data, offsets = text_buffers(column)
        sizes = np.diff(offsets)
        # One zero byte before and after each string.
        padded = np.zeros(len(data) + 2 * len(sizes), np.uint64)
        shift = 2 * np.repeat(np.arange(len(sizes)), sizes) + 1
        padded[np.arange(len(data)) + shift] = FOLD[data]
        owner = np.repeat(np.arange(len(sizes)), sizes + 2)
        for length in LENGTHS:
            count = len(padded) - length + 1
            if count <= 0:
                continue
            value = np.full(count, salt * 16 + length, np.uint64)
            for k in range(length):
                value = (value << np.uint64(8)) | padded[k : k + count]
            whole = owner[:count] == owner[length - 1 :]
            rows.append(owner[:count][whole])
            grams.append((mix(value[whole]) % np.uint64(DIMENSIONS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(grams)


def scores(hosts: pa.Array, paths: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of the label ``block``: the mean weight of a row's n-grams through the logistic function."""
    rows, grams = features(hosts, paths)
    total = np.bincount(rows, weights[grams], minlength=len(hosts))
    size = np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(hosts))))
    return 1 / (1 + np.exp(-np.clip(total / size + bias, -50, 50)))


def train(hosts: Sequence[str], paths: Sequence[str], labels: Sequence[int], *, rounds: int = 300, rate: float = 2.0, decay: float = 1e-3):
    """Weights and bias of the regression, classes weighted equally; gradient steps with the whole table each."""
    if len(labels) > MOST_LABELLED:
        raise ValueError(f"a labelled table of {len(labels)} rows; the driver takes {MOST_LABELLED}")
    y = np.asarray(labels, np.float64)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not len(y):
        return weights, bias
    rows, grams = features(pa.array(hosts, pa.string()), pa.array(paths, pa.string()))
    size = np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(y))))
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(rounds):
        z = np.bincount(rows, weights[grams], minlength=len(y)) / size + bias
        error = (1 / (1 + np.exp(-z)) - y) * share
        weights -= rate * len(LENGTHS) * 10 * (np.bincount(grams, (error / size)[rows], minlength=DIMENSIONS) + decay * weights / len(y))
        bias -= rate * error.sum()
    return weights, bias


def _scoring(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["score"] = pa.array(scores(batch.column("host"), batch.column("path"), weights, bias))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def judged(pages: DataFrame, labelled: Iterable[tuple[str, int]], rules: Sequence[tuple[str, str, str]] = RULES, *, key: str = "page_id", url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``: a row per row of ``pages``, in one pass without a shuffle.

    ``labelled``: urls with 1 for block, 0 for allow. ``score`` is the classifier's probability of block, also where a rule
    decided. A null url, or one without ``://``, has an empty host and path, fits no rule and is scored as such.
    Null and repeated ids are kept; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    labelled = [(u, label) for u, label in labelled]
    # The same columns cut the labelled urls: a small local table.
    table = _parts(spark.createDataFrame(labelled, "url string, label int"), "url", "label").collect() if labelled else []
    weights, bias = train([r.host for r in table], [r.path for r in table], [r.label for r in table])
    model = spark.sparkContext.broadcast((weights.astype(np.float32), bias))
    parts = _parts(pages, url, F.col(key).cast("long").alias("page_id"))
    found = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("_found", found).select("page_id", "host", "path", F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))
    scored = ruled.mapInArrow(_scoring(model), "page_id long, host string, path string, rule string, verdict string, score double")
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")))


def _parts(df: DataFrame, url: str, *kept) -> DataFrame:
    df = df.select(*kept, F.col(url).cast("string").alias("_u"))
    host, path = host_and_path(F.col("_u"))
    return df.withColumns({"host": host, "path": path}).drop("_u")
