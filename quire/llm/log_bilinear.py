"""Log-bilinear language model trained by noise-contrastive estimation.

The model predicts a token's output symbol from the ``CONTEXT`` symbols before
it: their vectors, scaled by position, add up to a predicted vector, and its
products with output vectors, plus biases, are log-scores. Symbols are the most
frequent words (as many as the square root of the number of training tokens,
``MAX_NAMED`` at most), ``TAILS`` classes that share out all other words by
their last three bytes, and the end of a text. A word of a tail class is then
predicted by its smoothed share of the class's training tokens, so the
probabilities of all words, seen or not, sum to one.

The output has two levels. Symbols in order of frequency are cut into groups of
equal mass of root frequency, about as many as the square root of their number;
the model predicts the group, then the symbol within its group. Both levels are
normalised exactly, by batched products, at a cost that grows with the square
root of the vocabulary.

Spark counts every training token. Training sees every training token once:
the training rows form rounds (more of them the more tokens there are); in
each, every task runs minibatch steps on its rows from the same start, and the
rounds' models are averaged in Spark: a symbol's vectors weighted by how often
the task met it, in blocks of symbols, summed map-side. A step contrasts the
groups and the symbols of a minibatch with noise drawn from their unigram
distributions and updates only the vectors it met, so its cost does not follow
the vocabulary.

Counts of the ``COMMON`` most frequent words are broadcast (a fixed number of
entries); all other words of a text meet their counts in a join by word. Words
are told apart by a 64-bit hash.

Tokens: A-Z lower-cased, words between ASCII white space, one end per text. A
null or empty text is its end alone. Rows are scored one by one, equal ids or
texts too; other columns are ignored. With no training rows the counts are 0
and the model is its start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SPACED_LOWER, fold, hash_spans, slices, text_bytes, word_spans, written

TAILS, CONTEXT, DIM = 64, 3, 12
#: Words with vectors of their own at most (some 20 MB of vectors), and counts broadcast.
MAX_NAMED, COMMON = 200_000, 200_000
BATCH, RATE = 1024, 0.2
#: Noise groups of a minibatch, noise symbols of each target.
NOISE, NOISE_IN_GROUP = 32, 2
#: Scores computed at once within a group.
CELLS = 1 << 19
#: Symbols whose vectors are averaged in one row.
BLOCK = 512
HELD_OUT = 1


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, tail classes, words before each row) of a text column."""
    data, off = text_bytes(col, SPACED_LOWER)
    starts, ends, before = word_spans(data, off)
    tail = hash_spans(data, np.maximum(starts, ends - 3), ends) % np.uint64(TAILS)
    return hash_spans(data, starts, ends), tail.astype(np.int64), before


def count_words(rows: DataFrame) -> DataFrame:
    """(h, tail, n) of all words of (id, text)."""

    def run(batches):
        for b in batches:
            for first, end in slices(b.column(0)):
                h, tail, _ = tokens(b.column(0).slice(first, end - first))
                own, at, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({"h": own.view(np.int64), "tail": pa.array(tail[at], pa.int32()), "n": n.astype(np.int64)})

    return rows.select("text").mapInArrow(run, "h long, tail int, n long").groupBy("h", "tail").agg(F.sum("n").alias("n"))


class Sorted:
    """Values by 64-bit key in sorted arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), missing, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], missing)


class Vocabulary:
    """What the counts tell the model; bounded by ``COMMON`` and the number of symbols.

    Symbols are numbered by falling count, so a group is a range of numbers:
    group g holds the symbols ``first[g]`` to ``first[g + 1] - 1``. ``share`` is a
    symbol's part of its group's mass, ``mass`` the group's of all, both smoothed.
    """

    def __init__(self, counts: DataFrame, texts: int):
        top = counts.orderBy(F.col("n").desc(), "h").limit(COMMON).toArrow()
        h, n, tails = top["h"].to_numpy().view(np.uint64), top["n"].to_numpy(), top["tail"].to_numpy()
        self.common = Sorted(h, n)
        by = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
        self.tail_n, self.tail_v = np.zeros(TAILS), np.zeros(TAILS)
        for r in by:
            self.tail_n[r["tail"]], self.tail_v[r["tail"]] = r["n"], r["v"]
        self.words, self.distinct = int(self.tail_n.sum()), int(self.tail_v.sum()) + (texts > 0)
        self.texts, self.total = texts, self.words + texts
        named = min(len(h), MAX_NAMED, round(self.total ** 0.5))
        np.subtract.at(self.tail_n, tails[:named], n[:named])
        np.subtract.at(self.tail_v, tails[:named], 1)
        count = np.r_[n[:named], self.tail_n, texts].astype(np.float64)
        order = np.argsort(-count, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.named_share = float(n[:named].sum()) / max(1, self.total)
        self.head = Sorted(h[:named], number[:named])
        self.tail_symbol, self.end, self.size = number[named:named + TAILS], int(number[-1]), len(number)
        self.begin = self.size
        self.group(count[order] + 0.5)

    def group(self, own: np.ndarray) -> None:
        root = np.sqrt(own)
        want = max(1, round(len(own) ** 0.5))
        before = np.r_[0, np.cumsum(root)[:-1]] / root.sum()
        _, self.group_of = np.unique((before * want).astype(np.int64), return_inverse=True)
        self.first = np.r_[np.flatnonzero(np.r_[True, np.diff(self.group_of) > 0]), len(own)]
        total = np.add.reduceat(own, self.first[:-1])
        self.mass, self.share = total / own.sum(), own / total[self.group_of]
        self.up_to = np.r_[0, np.cumsum(own / own.sum())]
        # log of the expected noise draws, which the contrast subtracts from a score
        self.group_noise = np.log(NOISE * self.mass).astype(np.float32)
        self.symbol_noise = np.log(NOISE_IN_GROUP * self.share).astype(np.float32)
        self.several = (np.diff(self.first) > 1).astype(np.float32)

    def symbols(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        own = self.head.get(h, -1)
        return np.where(own >= 0, own, self.tail_symbol[tail])

    def sequences(self, symbols: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols with begins and ends, places of the predicted ones): each row is
        ``CONTEXT`` begins, its words and the end."""
        n = np.diff(before)
        out = np.full(len(symbols) + len(n) * (CONTEXT + 1), self.begin, np.int64)
        first = before[:-1] + np.arange(len(n)) * (CONTEXT + 1) + CONTEXT
        places = np.arange(len(symbols)) + np.repeat(first - before[:-1], n)
        out[places], out[first + n] = symbols, self.end
        return out, np.flatnonzero(out != self.begin)


def sums_at(rows: np.ndarray, grad: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sum of the gradients of each); ``rows`` are below ``size``."""
    rows, grad = rows.ravel(), grad.reshape(rows.size, -1)
    # numbers of 16 bits are sorted by digits, without comparisons
    order = np.argsort(rows.astype(np.uint16) if size <= 1 << 16 else rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(grad.take(order, axis=0), first)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class LogBilinear:
    """Vectors of context symbols ``r`` (the begin mark last), of output symbols ``q`` and of
    groups ``g``, each output with its bias as last column; position scales ``c``."""

    PARTS = ("r", "q", "g", "c")

    def __init__(self, v: Vocabulary, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.v = v
        groups = len(v.mass)
        self.r = (rng.standard_normal((v.size + 1, DIM)) * 0.1).astype(np.float32)
        self.q = np.c_[rng.standard_normal((v.size, DIM)) * 0.1, np.log(v.share)].astype(np.float32)
        self.g = np.c_[rng.standard_normal((groups, DIM)) * 0.1, np.log(v.mass)].astype(np.float32)
        self.c = np.full((CONTEXT, DIM), 0.5, np.float32)

    def copy(self) -> "LogBilinear":
        out = LogBilinear.__new__(LogBilinear)
        out.v = self.v
        for p in self.PARTS:
            setattr(out, p, getattr(self, p).copy())
        return out

    def predicted(self, context: np.ndarray) -> np.ndarray:
        """The predicted vectors, with a 1 behind for the bias."""
        h = np.einsum("bjd,jd->bd", self.r.take(context, axis=0), self.c)
        return np.c_[h, np.ones(len(h), np.float32)]

    def update(self, part: str, rows, grad: np.ndarray, seen: dict[str, np.ndarray]) -> None:
        """Adagrad on the given rows, or all (None)."""
        own = getattr(self, part)
        if part not in seen:
            seen[part] = np.full(own.shape, 1e-8, np.float32)
        if rows is None:
            seen[part] += grad * grad
            own -= RATE * grad / np.sqrt(seen[part])
            return
        total = seen[part].take(rows, axis=0) + grad * grad
        seen[part][rows] = total
        own[rows] = own.take(rows, axis=0) - RATE * grad / np.sqrt(total)

    def step(self, context: np.ndarray, target: np.ndarray, rng, seen: dict[str, np.ndarray]) -> None:
        """One minibatch: gradients of both contrastive losses, then an update of what was met."""
        v, n = self.v, len(target)
        e = self.r.take(context, axis=0)
        h = np.concatenate([np.einsum("bjd,jd->bd", e, self.c), np.ones((n, 1), np.float32)], axis=1)
        own = v.group_of[target]
        # groups, against noise groups that the whole minibatch shares
        drawn = v.group_of[np.minimum(np.searchsorted(v.up_to, rng.random(NOISE), side="right") - 1, v.size - 1)]
        g_own, g_drawn = self.g.take(own, axis=0), self.g.take(drawn, axis=0)
        real = sigmoid(np.einsum("bd,bd->b", h, g_own) - v.group_noise[own]) - 1
        fake = sigmoid(h @ g_drawn.T - v.group_noise[drawn])
        dh = real[:, None] * g_own + fake @ g_drawn
        grads = [("g", *sums_at(np.concatenate([own, drawn]), np.concatenate([real[:, None] * h, fake.T @ h]), len(self.g)))]
        # symbols, against noise of the target's own group
        first, end = v.first[own], v.first[own + 1]
        low, high = v.up_to[first], v.up_to[end]
        other = np.searchsorted(v.up_to, low + rng.random((NOISE_IN_GROUP, n)) * (high - low), side="right") - 1
        rows = np.concatenate([target[None], np.clip(other, first, end - 1)])  # the target, then its noise
        q = self.q.take(rows, axis=0)
        pull = sigmoid(np.einsum("bd,kbd->kb", h, q) - v.symbol_noise[rows])
        pull[0] -= 1
        pull *= v.several[own]
        dh += np.einsum("kb,kbd->bd", pull, q)
        grads.append(("q", *sums_at(rows, pull[:, :, None] * h, v.size)))
        dh = dh[:, :DIM]
        grads.append(("r", *sums_at(context, dh[:, None, :] * self.c, v.size + 1)))
        grads.append(("c", None, np.einsum("bd,bjd->jd", dh, e)))
        for part, rows, grad in grads:
            self.update(part, rows, grad / n, seen)

    def log10(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the targets: of the group, then within it."""
        v, out = self.v, np.empty(len(target))
        own = v.group_of[target]
        h = np.empty((len(target), DIM + 1), np.float32)
        for k in range(0, len(target), 4096):
            at = slice(k, k + 4096)
            h[at] = self.predicted(context[at])
            out[at] = log_softmax_at(h[at] @ self.g.T, own[at])
        order = np.argsort(own, kind="stable")
        cut = np.searchsorted(own[order], np.arange(len(v.mass) + 1))
        for k in np.flatnonzero(np.diff(cut) * (np.diff(v.first) > 1)).tolist():
            first, end = v.first[k], v.first[k + 1]
            step = max(1, CELLS // int(end - first))
            for lo in range(cut[k], cut[k + 1], step):
                at = order[lo:min(lo + step, cut[k + 1])]
                out[at] += log_softmax_at(h[at] @ self.q[first:end].T, target[at] - first)
        return out / np.log(10)


def log_softmax_at(scores: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at its column; ``scores`` is used up."""
    own = scores[np.arange(len(scores)), column].astype(np.float64)
    top = scores.max(axis=1, keepdims=True)
    scores -= top
    np.exp(scores, out=scores)
    return own - top[:, 0] - np.log(scores.sum(axis=1, dtype=np.float64))


def contexts(seq: np.ndarray, places: np.ndarray) -> np.ndarray:
    return seq[places[:, None] - np.arange(CONTEXT, 0, -1)]


def rounds_of(tokens: int) -> int:
    """Rounds of training: two for a million tokens, one more for each tenfold."""
    return max(1, round(np.log10(max(tokens, 1))) - 4)


def train_round(rows: DataFrame, model: LogBilinear) -> LogBilinear:
    """One pass over ``rows`` (text), from ``model``: local steps in every task, then the average."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = model.v
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value.copy()
        v = own.v
        rng, seen, met = np.random.default_rng(TaskContext.get().partitionId()), {}, np.zeros(v.size + 1)
        for b in batches:
            for first, end in slices(b.column(0)):
                h, tail, before = tokens(b.column(0).slice(first, end - first))
                seq, places = v.sequences(v.symbols(h, tail), before)
                for at in np.array_split(rng.permutation(places), -(-len(places) // BATCH)):
                    own.step(contexts(seq, at), seq[at], rng, seen)
                met += np.bincount(seq, minlength=v.size + 1)
        total = float(met[:-1].sum())
        if total:
            flat = np.r_[own.g.ravel(), own.c.ravel()].astype(np.float64)
            yield pa.RecordBatch.from_pydict({"block": pa.array([-1], pa.int32()), "x": pa.array([np.r_[total, total * flat]], pa.list_(pa.float64()))})
            q = np.r_[own.q, np.zeros((1, DIM + 1), np.float32)]
            for k in np.unique(np.flatnonzero(met) // BLOCK).tolist():
                at = slice(k * BLOCK, (k + 1) * BLOCK)
                x = np.c_[met[at], met[at, None] * own.r[at], met[at, None] * q[at]]
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "x": pa.array([x.ravel()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(run, "block int, x array<double>").select("block", array_to_vector("x").alias("x"))
    sums = parts.groupBy("block").agg(vector_to_array(Summarizer.sum(F.col("x"))).alias("x")).collect()  # as many rows as blocks
    out = model.copy()
    for r in sums:
        x = np.array(r["x"])
        if r["block"] < 0:
            flat = x[1:] / x[0]
            out.g, out.c = (part.astype(np.float32) for part in (flat[:out.g.size].reshape(out.g.shape), flat[out.g.size:].reshape(out.c.shape)))
            continue
        x = x.reshape(-1, 2 * DIM + 2)
        own = np.flatnonzero(x[:, 0])
        mean, at = x[own, 1:] / x[own, :1], r["block"] * BLOCK + own
        out.r[at] = mean[:, :DIM]
        out.q[at[at < v.size]] = mean[at < v.size, DIM:]
    sent.destroy()
    return out


def fit(train: DataFrame) -> tuple[DataFrame, LogBilinear]:
    """The counts (h, tail, n) of all words of (id, text), and the trained model."""
    counts = written(count_words(train), "words")
    v = Vocabulary(counts, train.count())
    model = LogBilinear(v)
    rounds = rounds_of(v.total)
    for k in range(rounds):
        model = train_round(train.filter(F.pmod(F.xxhash64("id"), F.lit(rounds)) == k).select("text"), model)
    return counts, model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows outside fold ``HELD_OUT`` and score all: id, held_out, n_tokens,
    n_known, train_tokens, base_score, score."""
    part = fold(id_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), part.alias("fold"))
    counts, model = fit(rows.filter(F.col("fold") != HELD_OUT).select("id", "text"))
    return score_rows(rows.select("id", "text", (F.col("fold") == HELD_OUT).alias("held_out")), counts, model).withColumnRenamed("id", id_col)


def score_rows(rows: DataFrame, counts: DataFrame, model: LogBilinear) -> DataFrame:
    """Score (id, text, held_out) by a trained model."""
    v = model.v
    sent = rows.sparkSession.sparkContext.broadcast(model)
    names = ["id", "row", "h", "k", "held_out", "n_tokens", "n_known", "base", "score"]

    def run(batches):
        model = sent.value
        v = model.v
        row = TaskContext.get().partitionId() << 33
        floor = np.log10(v.total + 0.5 * (v.distinct + 1))
        of_class = np.log10(v.tail_n + 0.5 * (v.tail_v + 1))
        for b in batches:
            for first, end in slices(b.column(1)):
                own = b.slice(first, end - first)
                h, tail, before = tokens(own.column(1))
                seq, places = v.sequences(v.symbols(h, tail), before)
                lp = model.log10(contexts(seq, places), seq[places])
                n = np.diff(before)
                score = np.add.reduceat(lp, before[:-1] + np.arange(len(n)))
                c = v.common.get(h, -1)
                of = np.repeat(np.arange(len(n)), n)
                in_class = v.head.get(h, -1) < 0
                seen = np.log10(np.maximum(c, 0) + 0.5)
                score += np.bincount(of, weights=np.where(in_class, np.where(c >= 0, seen, 0) - of_class[tail], 0), minlength=len(n))
                base = np.bincount(of, weights=np.where(c >= 0, seen, 0), minlength=len(n)) + np.log10(v.texts + 0.5) - (n + 1) * floor
                known = np.bincount(of, weights=c >= 0, minlength=len(n)).astype(np.int64) + (v.texts > 0)
                ids = np.arange(row, row + len(n))
                row += len(n)
                yield pa.RecordBatch.from_arrays([
                    own.column(0), pa.array(ids), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64()), own.column(2),
                    pa.array((n + 1).astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)], names=names)
                rare = np.flatnonzero(c < 0)
                key = np.stack([of[rare], h[rare].view(np.int64)])
                order = np.lexsort(key[::-1])
                key = key[:, order]
                new = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]) if len(rare) else order
                m = len(new)
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(m, own.column(0).type), pa.array(ids[key[0, new]] if m else ids[:0]), pa.array(key[1, new]),
                    pa.array(np.diff(np.r_[new, len(rare)]).astype(np.int64)), pa.nulls(m, pa.bool_()), *[pa.nulls(m, pa.int64())] * 2, *[pa.nulls(m, pa.float64())] * 2], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    scored = written(rows.mapInArrow(
        run, f"id {kind}, row long, h long, k long, held_out boolean, n_tokens long, n_known long, base double, score double"), "scores")
    rare = scored.filter(F.col("h").isNotNull()).select("row", "h", "k").join(counts.select("h", "n"), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("more"),
                                   F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("more_known"))
    out = scored.filter(F.col("h").isNull()).join(rare, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(v.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
