"""Online variational LDA whose topic weights stay in term blocks over the cluster.

An update sees a random share of the documents.  Each partition of documents asks the term
blocks for the rows of the words it drew, infers its documents' topics, and sends back what
it found for these rows; the blocks are updated where they are.  The driver holds a number
for each topic only.  The rates and the update of the documents' prior are those of the
published algorithm, as pyspark.ml has them.

What an update leaves on disk goes once the next one stands: files of its shuffles, held
partitions, and the checkpoint before the last.  Rows of words are made where the blocks are
and go straight to their shuffle; neither held partitions nor checkpoints have them.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame

from scoreloom.plans.durable import drop_checkpoint, release_shuffles, shared_folder

# The code of the tasks travels with the plan: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 16
LEAST_BLOCKS = 8
TAU, KAPPA = 1024.0, 0.51
CHANGE = 1e-3
CHECKPOINT_EVERY = 20
# Partitions of documents whose topics are found at once.
PARTS_AT_ONCE = 8


def digamma(x: np.ndarray) -> np.ndarray:
    y = x + 6.0
    f = 1.0 / (y * y)
    tail = f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))
    low = 1 / x + 1 / (x + 1) + 1 / (x + 2) + 1 / (x + 3) + 1 / (x + 4) + 1 / (x + 5)
    return np.log(y) - 0.5 / y - tail - low


def trigamma(x: np.ndarray) -> np.ndarray:
    y = x + 6.0
    f = 1.0 / (y * y)
    tail = f / y * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))
    low = sum(1 / (x + i) ** 2 for i in range(6))
    return 1 / y + 0.5 * f + tail + low


@dataclass
class Documents:
    """Sparse documents of a partition: ``columns`` and ``counts`` of each between ``starts``."""

    starts: np.ndarray
    columns: np.ndarray
    counts: np.ndarray
    kept: list[tuple]


@dataclass
class TopicWeights:
    """Blocks (number, weights): block b of B has the rows of the terms b, b + B, b + 2 B, ..."""

    blocks: RDD
    n_blocks: int
    n_terms: int
    total: np.ndarray
    alpha: np.ndarray


def documents_of(
    rows: DataFrame, features: str, *kept: str, parts: range | None = None
) -> RDD:
    """A (partition, documents) pair for each partition, or for those in ``parts``."""

    def gather(at: int, part: Iterator) -> Iterator[tuple[int, Documents]]:
        if parts is not None and at not in parts:
            return
        sizes, columns, counts, others = [0], [], [], []
        for vector, *other in part:
            sizes.append(len(vector.indices))
            columns.append(vector.indices)
            counts.append(vector.values.astype(np.float32))
            others.append(tuple(other))
        none = np.zeros(0, np.int32)
        yield at, Documents(
            np.cumsum(sizes),
            np.concatenate([none, *columns]),
            np.concatenate([none.astype(np.float32), *counts]),
            others if kept else [],
        )

    return rows.select(features, *kept).rdd.mapPartitionsWithIndex(gather)


def infer(rows: np.ndarray, counts: np.ndarray, alpha: np.ndarray) -> tuple:
    """A document's topics: their weights, and exp(E log) of its mixture."""
    gamma = np.ones(len(alpha))
    while True:
        mixture = np.exp(digamma(gamma) - digamma(gamma.sum()))
        found = mixture * ((counts / (rows @ mixture + 1e-100)) @ rows) + alpha
        change = np.abs(found - gamma).mean()
        gamma = found
        if change <= CHANGE:
            expected = digamma(gamma) - digamma(gamma.sum())
            return gamma, np.exp(expected), expected


def _drawn(docs: Documents, seed: tuple, rate: float) -> np.ndarray:
    """How often an update sees each document; once if there is no ``rate``."""
    n = len(docs.starts) - 1
    return np.random.default_rng(seed).poisson(rate, n) if rate else np.ones(n, int)


def _words(docs: Documents, drawn: np.ndarray) -> np.ndarray:
    return np.unique(docs.columns[np.repeat(drawn > 0, np.diff(docs.starts))])


def _by_block(ids: np.ndarray, n_blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(ids % n_blocks, kind="stable")
    edges = np.searchsorted(ids[order] % n_blocks, np.arange(n_blocks + 1))
    for b in range(n_blocks):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b] : edges[b + 1]]


def _asks(at: int, words: np.ndarray, n_blocks: int) -> Iterator[tuple]:
    for b, own in _by_block(words, n_blocks):
        yield b, ("ask", at, words[own])


def _updated(part: Iterator[tuple], n_blocks: int, keep: float, add: float, eta: float):
    """The updated block, and who asks for which of its rows."""
    number, weights, found, asked = None, None, [], []
    for b, (kind, first, second) in part:
        if kind == "block":
            number, weights = b, first
        elif kind == "found":
            found.append((first, second))
        else:
            asked.append((first, second))
    if number is None:
        return
    if keep < 1.0:
        weights = keep * weights + (1.0 - keep) * eta
        for ids, sums in found:
            weights[ids // n_blocks] += add * sums
    yield number, ("block", weights, None)
    for at, ids in asked:
        yield number, ("ask", at, ids)


def _answers(part: Iterator[tuple], n_blocks: int) -> Iterator[tuple]:
    """The rows the askers want: exp(digamma) of their weights."""
    weights = None
    for _, (kind, first, second) in part:
        if kind == "block":
            weights = first
        else:
            yield first, (second, np.exp(digamma(weights[second // n_blocks])))


def _gathered(part: Iterator[tuple], scale: np.ndarray) -> tuple:
    """The documents of a partition, their words and the words' rows."""
    at, docs, pieces = None, None, []
    for p, value in part:
        if isinstance(value, Documents):
            at, docs = p, value
        else:
            pieces.append(value)
    if docs is None:
        return None, None, None, None
    none, k = np.zeros(0, np.int32), len(scale)
    ids = np.concatenate([none, *(i for i, _ in pieces)])
    rows = np.concatenate([np.zeros((0, k)), *(r for _, r in pieces)]) / scale
    order = np.argsort(ids)
    return at, docs, ids[order], rows[order]


def _together(a: RDD, b: RDD, n: int) -> RDD:
    """Both in the partitions of their keys; ``a`` is there already and is not moved."""
    return a.union(b.partitionBy(n)).partitionBy(n)


def _blocks_of(updated: RDD) -> RDD:
    return updated.mapPartitions(lambda p: (x for x in p if x[1][0] == "block"), True)


def fit(
    rows: DataFrame, features: str, n_terms: int, n_docs: int, k: int, updates: int, rate: float,
    seed: int,
) -> TopicWeights:
    """Topic weights of sparse count vectors after so many updates."""
    spark = rows.sparkSession
    shared_folder(spark)
    n_blocks = max(LEAST_BLOCKS, -(-n_terms // BLOCK_ROWS))
    eta, alpha = 1.0 / k, np.full(k, 1.0 / k)
    docs = documents_of(rows, features)
    n_parts = max(1, docs.getNumPartitions())
    docs = docs.partitionBy(n_parts).persist(StorageLevel.MEMORY_AND_DISK)
    docs.count()
    release_shuffles(docs)

    def begin(b: int) -> tuple:
        size = len(range(b, n_terms, n_blocks))
        return b, ("block", np.random.default_rng((seed, b)).gamma(100.0, 0.01, (size, k)), None)

    blocks = spark.sparkContext.parallelize(range(n_blocks), n_blocks).map(begin)
    blocks = blocks.partitionBy(n_blocks).persist(StorageLevel.MEMORY_AND_DISK)
    total = blocks.map(lambda x: x[1][1].sum(0)).reduce(lambda a, b: a + b)

    def first_asks(part: Iterator[tuple]) -> Iterator[tuple]:
        for at, d in part:
            yield from _asks(at, _words(d, _drawn(d, (seed, 1, at), rate)), n_blocks)

    messages, keep, add = docs.mapPartitions(first_asks), 1.0, 0.0
    held, written = [blocks], None
    for update in range(1, updates + 1):
        met = _together(blocks, messages, n_blocks)
        updated = met.mapPartitions(
            lambda p, keep=keep, add=add: _updated(p, n_blocks, keep, add, eta), True
        ).persist(StorageLevel.MEMORY_AND_DISK)
        if update % CHECKPOINT_EVERY == 0:
            updated.checkpoint()
        scale = np.exp(digamma(total))

        def learn(part: Iterator[tuple], update=update, scale=scale, alpha=alpha) -> Iterator:
            at, d, ids, beta = _gathered(part, scale)
            if d is None:
                return
            drawn = _drawn(d, (seed, update, at), rate)
            sums, logs, seen = np.zeros_like(beta), np.zeros(len(alpha)), 0
            for i in np.flatnonzero(drawn & (np.diff(d.starts) > 0)).tolist():
                own = slice(d.starts[i], d.starts[i + 1])
                local = np.searchsorted(ids, d.columns[own])
                mine, counts = beta[local], d.counts[own]
                _, mixture, expected = infer(mine, counts, alpha)
                sums[local] += drawn[i] * np.outer(counts / (mine @ mixture + 1e-100), mixture)
                logs += drawn[i] * expected
                seen += int(drawn[i])
            sums *= beta
            for b, own in _by_block(ids, n_blocks):
                yield b, ("found", ids[own], sums[own])
            if update < updates:
                again = _drawn(d, (seed, update + 1, at), rate)
                yield from _asks(at, _words(d, again), n_blocks)
            yield -1, (sums.sum(0), logs, seen)

        answers = updated.mapPartitions(lambda p: _answers(p, n_blocks))
        learnt = _together(docs, answers, n_parts).mapPartitions(learn)
        learnt = learnt.persist(StorageLevel.MEMORY_AND_DISK)
        sums, logs, seen = learnt.filter(lambda x: x[0] < 0).values().reduce(
            lambda a, b: tuple(x + y for x, y in zip(a, b, strict=True))
        )
        release_shuffles(met)
        release_shuffles(learnt)
        for old in held:
            old.unpersist()
        if update % CHECKPOINT_EVERY == 0:
            drop_checkpoint(written)
            written = updated
        held = [updated, learnt]
        blocks, messages = _blocks_of(updated), learnt.filter(lambda x: x[0] >= 0)
        keep, add = 1.0, 0.0
        if seen:
            weight = (TAU + update) ** -KAPPA
            keep, add = 1.0 - weight, weight * n_docs / math.ceil(rate * n_docs)
            total = keep * total + weight * eta * n_terms + add * sums
            alpha = _moved(alpha, logs / seen, seen, weight)
    met = _together(blocks, messages, n_blocks)
    last = met.mapPartitions(
        lambda p: _updated(p, n_blocks, keep, add, eta), True
    ).persist(StorageLevel.MEMORY_AND_DISK)
    last.checkpoint()
    last.count()
    release_shuffles(met)
    for old in [*held, docs]:
        old.unpersist()
    drop_checkpoint(written)
    return TopicWeights(last, n_blocks, n_terms, total, alpha)


def _moved(alpha: np.ndarray, logs: np.ndarray, n: int, weight: float) -> np.ndarray:
    """A weighed Newton step of the documents' prior, if it stays positive."""
    slope = n * (digamma(alpha.sum()) - digamma(alpha) + logs)
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - weight * (slope - b) / q
    return moved if (moved > 0).all() else alpha


def distributions(
    model: TopicWeights, rows: DataFrame, features: str, keep: Callable[[RDD], None], *kept: str
) -> None:
    """A (kept columns, topic shares) tuple per document; without words all shares are zero.

    Some partitions at a time are handed to ``keep``, which is to write them before it returns:
    the rows of their words are then given up.
    """
    n_parts, n_blocks = max(1, rows.rdd.getNumPartitions()), model.n_blocks
    scale, alpha = np.exp(digamma(model.total)), model.alpha

    def asks(part: Iterator[tuple]) -> Iterator[tuple]:
        for at, d in part:
            yield from _asks(at, _words(d, _drawn(d, (), 0.0)), n_blocks)

    def shares(part: Iterator[tuple]) -> Iterator[tuple]:
        _, d, ids, beta = _gathered(part, scale)
        for i, others in enumerate(d.kept if d else []):
            own = slice(d.starts[i], d.starts[i + 1])
            if d.starts[i] == d.starts[i + 1]:
                yield *others, [0.0] * len(alpha)
                continue
            gamma = infer(beta[np.searchsorted(ids, d.columns[own])], d.counts[own], alpha)[0]
            yield *others, (gamma / gamma.sum()).tolist()

    for first in range(0, n_parts, PARTS_AT_ONCE):
        parts = range(first, first + PARTS_AT_ONCE)
        docs = documents_of(rows, features, *kept, parts=parts)
        docs = docs.map(lambda x, first=first: (x[0] - first, x[1])).partitionBy(PARTS_AT_ONCE)
        docs = docs.persist(StorageLevel.DISK_ONLY)
        met = _together(model.blocks, docs.mapPartitions(asks), n_blocks)
        answers = met.mapPartitions(lambda p: _updated(p, n_blocks, 1.0, 0.0, 0.0), True)
        answers = answers.mapPartitions(lambda p: _answers(p, n_blocks))
        found = _together(docs, answers, PARTS_AT_ONCE).mapPartitions(shares)
        keep(found)
        release_shuffles(found)
        release_shuffles(met)
        release_shuffles(docs)
        docs.unpersist()


def top_terms(model: TopicWeights, n: int) -> list[list[tuple[int, float]]]:
    """For each topic the ``n`` terms of the largest weights, as shares; the first of equals."""
    n_blocks, total = model.n_blocks, model.total

    def best(part: Iterator[tuple]) -> Iterator[tuple]:
        for b, (_, weights, _) in part:
            for topic in range(weights.shape[1]):
                for i in np.argsort(-weights[:, topic], kind="stable")[:n].tolist():
                    yield topic, (-weights[i, topic] / total[topic], i * n_blocks + b)

    found: list[list] = [[] for _ in total]
    for topic, pair in model.blocks.mapPartitions(best).collect():  # blocks x topics x n
        found[topic].append(pair)
    return [[(i, float(-share)) for share, i in sorted(pairs)[:n]] for pairs in found]
