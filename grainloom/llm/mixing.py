"""Mixing sources to target weights (problem 9).

Documents without a source get domain posteriors from a classifier trained on the labelled ones; the
label of a labelled document is its posterior. Projected-gradient least squares then fits a rate for each
document so that the expected tokens of each domain meet the targets. A rate is the posterior times a
vector of domain rates between 0 and the caps, so the gradient of all documents is a product with the
sums of tokens times posterior times posterior: one distributed pass adds them up, a matrix as wide as the
list of sources, and the steps need no further pass.
"""

from __future__ import annotations

import base64
import os
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainloom.llm import arrays
from grainloom.session import checkpoint

#: A file of the package of public tokenizers, or a path.
TOKENIZER = "byte_bpe_50k.tiktoken"
BUCKETS = 1 << 15


def load_tokenizer(path: str):
    import public_tokenizers
    import tiktoken

    with open(path if os.path.isabs(path) else public_tokenizers.path(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of the texts, and the range of each text."""
    names, _, _, ranges = arrays.words([t.casefold() for t in texts], arrays.alnum_table())
    return (names >> np.uint64(49)).astype(np.int64), ranges


def train_domains(documents: DataFrame, domains: list[str], *, per_domain: int = 300) -> np.ndarray:
    """Naive Bayes log weights (domain x bucket) from at most ``per_domain`` labelled texts of each domain."""
    labelled = documents.filter(F.col("source").isin(domains) & F.col("text").isNotNull())
    first = Window.partitionBy("source").orderBy(F.xxhash64("text"), "doc_id")
    sample = labelled.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_domain).select("source", "text").collect()
    counts = np.full((len(domains), BUCKETS), 0.5)
    for row in sample:
        buckets, _ = word_features([row["text"]])
        np.add.at(counts[domains.index(row["source"])], buckets, 1)
    weights = np.log(counts / counts.sum(axis=1, keepdims=True))
    weights[[d not in {r["source"] for r in sample} for d in domains]] = -1e9  # no document is of a domain without labelled ones
    return weights


def measured(documents: DataFrame, domains: list[str], weights: np.ndarray, tokenizer: str) -> DataFrame:
    """``doc_id, source, tokens, posterior`` for each document; one pass, no shuffle."""
    model = documents.sparkSession.sparkContext.broadcast(weights)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_tokenizer(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            tokens = [len(encoder.encode_ordinary(t)) for t in texts]
            posterior = []
            for source, text in zip(batch.column(1).to_pylist(), texts):
                if source is not None:
                    posterior.append([float(d == source) for d in domains])
                    continue
                buckets, _ = word_features([text])
                score = model.value[:, buckets].sum(axis=1)
                p = np.exp(score - score.max())
                posterior.append((p / p.sum()).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(posterior, pa.list_(pa.float64()))], ["doc_id", "source", "tokens", "posterior"])

    rows = documents.filter("doc_id is not null").select(F.col("doc_id").cast("bigint"), "source", "text")
    return rows.mapInArrow(scan, "doc_id bigint, source string, tokens bigint, posterior array<double>")


def fitted_domains(gram: np.ndarray, share: np.ndarray, cap: np.ndarray, total: float | None = None, *, steps: int = 100_000, tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
    """Rates of the domains within 0 .. cap, and how far the worst domain stays from its part of the total.

    ``gram`` holds the sums of tokens x posterior x posterior, so ``gram @ rates`` are the expected tokens.
    The total is ``total``, or less if a cap allows no more. Each step goes along the gradient, scaled by
    the tokens of each domain, and back into the box; domains without documents stay at 0.
    """
    have = gram.sum(axis=1)
    there = (have > 0) & (share > 0)
    rates = np.zeros(len(have))
    if not there.any():
        return rates, 0.0
    g = np.where(there, share, 0.0)[there] / share[there].sum()
    a, most = gram[np.ix_(there, there)], cap[there]
    whole = np.linalg.lstsq(a, g, rcond=None)[0]
    largest = min((m / w for m, w in zip(most, whole) if w > 0), default=0.0)
    goal = g * (largest if total is None else min(total, largest))
    h = np.minimum(most, goal / have[there])
    for _ in range(steps):
        error = goal - a @ h
        if (np.abs(error) <= tolerance * goal.sum()).all():
            break
        h = np.clip(h + error / have[there], 0.0, most)
    rates[there] = h
    return rates, float(np.abs(goal - a @ h).max() / max(goal.sum(), 1e-9))


def mix_sources(
    documents: DataFrame, targets: DataFrame, *, tokenizer: str = TOKENIZER, total_tokens: int | None = None, per_domain: int = 300, tolerance: float = 1e-4, run: int = 100_000,
) -> DataFrame:
    """The chosen documents with their repeats: ``doc_id, source, domain, tokens, rate, repeats`` (repeats of 1 or more).

    ``targets`` (source, target_share, max_repeats) has a row for each domain; ``domain`` is the source, or the
    likeliest domain of a document without one. Without ``total_tokens`` the mixture is as large as it can be
    with every domain that has documents at its share. A domain without documents gets nothing and its
    share goes to the others in proportion. A rate becomes a whole number of repeats: of each domain the
    documents are taken in the order of their hash, one repeat more than the whole part of the rate, until
    their tokens reach what the fractions add up to, so a domain misses its tokens by no more than one
    document (in runs of about ``run`` documents, each for itself). Repeats never exceed the cap. A warning
    is given if the fit stays farther than ``tolerance`` of the total from a target. Documents of a source
    that has no target are left out. Null texts have no tokens and are not chosen; each row of a repeated
    doc_id counts; empty tables give no rows.
    """
    wanted = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in targets.filter("source is not null and target_share > 0").collect()}
    domains = sorted(wanted)
    if not domains:
        return documents.sparkSession.createDataFrame([], "doc_id bigint, source string, domain string, tokens bigint, rate double, repeats int")
    share, cap = (np.array([wanted[d][i] for d in domains], dtype=float) for i in (0, 1))
    width = len(domains)
    docs = checkpoint(measured(documents, domains, train_domains(documents, domains, per_domain=per_domain), tokenizer)).filter("tokens > 0")

    def posteriors(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of the matrix and numbers of documents, one vector a task."""
        gram, n = np.zeros((width, width)), np.zeros(width, dtype=np.int64)
        for batch in batches:
            p = posteriors(batch.column(0))
            gram += p.T @ (p * batch.column(1).to_numpy()[:, None])
            n += np.bincount(p.argmax(axis=1)[p.any(axis=1)], minlength=width)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)), pa.array(gram.ravel()), pa.array(np.repeat(n, width))], ["i", "j", "x", "n"])

    sums = docs.select("posterior", "tokens").mapInArrow(add_up, "i bigint, j bigint, x double, n bigint").groupBy("i", "j").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    gram, n_docs = np.zeros((width, width)), np.zeros(width, dtype=np.int64)
    for r in sums.collect():  # as many numbers as there are pairs of targets
        gram[r["i"], r["j"]], n_docs[r["i"]] = r["x"], r["n"]
    rates, miss = fitted_domains(gram, share, cap, total_tokens)
    if miss > tolerance:
        warnings.warn(f"the shares cannot be met: the fit misses a target by {miss:.4%} of the tokens")

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = posteriors(batch.column(3))
            of = pa.array(domains, pa.string()).take(pa.array(p.argmax(axis=1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), of, pa.array((p @ rates).round(9)), pa.array(np.floor(p @ cap + 1e-9))], ["doc_id", "source", "tokens", "domain", "rate", "cap"])

    rated = docs.mapInArrow(rate, "doc_id bigint, source string, tokens bigint, domain string, rate double, cap double").filter("rate > 0")
    n_runs = F.create_map(*[F.lit(x) for d, n in zip(domains, n_docs.tolist()) for x in (d, max(1, -(-n // run)))])
    whole = F.least(F.floor("rate"), F.col("cap").cast("bigint"))
    parted = rated.withColumn("whole", whole).withColumn("rest", F.when(F.col("whole") < F.col("cap"), F.col("rate") - F.col("whole")).otherwise(0.0))
    parted = parted.withColumn("run", F.pmod(F.xxhash64("doc_id", F.lit("run")), n_runs[F.col("domain")]))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 40)) / F.nullif("rest", F.lit(0.0))  # without a rest: null, which comes first and takes nothing
    part = Window.partitionBy("domain", "run")
    taken = F.sum(F.when(F.col("rest") > 0, F.col("tokens"))).over(part.orderBy(draw, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    due = F.sum(F.round(F.col("rest") * F.col("tokens") * 1000).cast("bigint")).over(part)
    more = (F.col("rest") > 0) & (taken * 1000 - F.col("tokens") * 500 <= due)
    repeats = (F.col("whole") + F.when(more, 1).otherwise(0)).cast("int")
    return parted.select("doc_id", "source", "domain", "tokens", "rate", repeats.alias("repeats")).filter("repeats > 0")


def reached_shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target source: target and reached share, tokens, most repeats, and how many documents had no source."""
    per = mixture.groupBy(F.col("domain").alias("s")).agg(F.count("*").alias("n_documents"), F.count_if(F.col("source").isNull()).alias("n_unlabelled"), F.max("repeats").alias("most_repeats"), F.sum(F.col("tokens") * F.col("repeats")).alias("n_tokens"))
    rows = targets.select("source", "target_share", "max_repeats").join(per, F.col("source") == F.col("s"), "left")
    of_all = F.col("n_tokens") / F.sum("n_tokens").over(Window.partitionBy())  # as many rows as sources
    return rows.select("source", "target_share", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_documents", "n_unlabelled", "most_repeats", "n_tokens")], F.coalesce(F.round(of_all, 6), F.lit(0.0)).alias("reached_share"))
