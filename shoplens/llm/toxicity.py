"""Toxicity by class-conditional Kneser-Ney models of the letters in words.

Two 5-gram models, one of toxic and one of ordinary texts, give the likelihood of every word letter by
letter, so an inflected or misspelt insult is judged by the stem it shares with known ones. A class knows
its own 5-gram counts; all lower orders are continuation counts shared by both classes and gathered from the
whole corpus, so a rare expression is judged by the shared counts alone, alike in both models, until one
class has evidence of its own. A count is the number of documents with the word, whatever its repeats.

The log-likelihoods are compared length-normalised, for the text as a whole and for its most toxic words;
a logistic curve, fitted on labelled texts that the counts have not seen, turns the comparison into a score.

Bounds, both parameters: labelled rows per class for the counts and for the curve. Whatever else is counted covers every
document. A task holds the shared counts themselves as long as they are few; of more it holds the probabilities of the
4-grams in most documents, and Spark looks up those of the words with any other, so no count is left out.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tables import parts, pick
from shoplens.scratch import materialize

ORDER = 5
#: Bits of a letter in an n-gram's number.
BITS = 12
DISCOUNT = 0.75
#: Discounts of the classes' own counts that are tried: the larger, the more documents it takes to believe a class.
CLASS_DISCOUNTS = (0.75, 1.5, 3.0)
#: Labelled rows of each class, at most: for the counts, and for the curve.
COUNT_ROWS, CURVE_ROWS = 20_000, 5_000
#: n-grams in a task that no labelled document holds, at most, and the documents that a 5-gram must be found in.
MODEL_GRAMS, MIN_DOCS = 1_000_000, 2
#: Distinct words that a task counts before it hands on their 5-grams, and words whose likelihood it remembers.
COUNTED, REMEMBERED = 100_000, 100_000
#: Letters of the texts that are split into words together.
CHUNK = 500_000
#: One part in so many of the labelled documents is held out; of the rest, remainder 4 is for the curve.
FOLDS, HELD_OUT, CURVE = 5, 0, 4
STRIP = ".,;:!?\"'()[]{}*%$&#|<>-_/"
# Used where no labelled rows are left for the curve: offset, then weights of the features.
DEFAULT_CURVE = np.array([-4.0, 0.0, 2.0, 0.0])
MOST = 15.0


def words_of(text: str | None) -> list[str]:
    return [w for raw in (text or "").lower().split() if (w := raw.strip(STRIP))]


def _letters(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """5-gram numbers of all words, one for each letter and one for the end, and how many each word has.

    A letter's number is its code point folded into 12 bits, from 2; 0 stands before a word and 1 after it.
    """
    joined = "".join(f"{'\0' * (ORDER - 1)}{w}\1" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    codes = np.where(points < 2, points, points % ((1 << BITS) - 3) + 2)
    sizes = np.fromiter((len(w) + 1 for w in words), dtype=np.int64)
    grams = np.zeros(len(codes) - ORDER + 1 if len(codes) else 0, dtype=np.int64)
    for i in range(ORDER):
        grams = grams << BITS | codes[i : len(codes) - ORDER + 1 + i]
    # Each word's windows start at its padding; those that reach into the next word are left out.
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    return grams[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())], sizes


def _plain(words: Iterable[str]) -> list[str]:
    return [w.replace("\0", "").replace("\1", "") for w in words]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    found, of = np.unique(keys, return_inverse=True)
    return (found, *(np.bincount(of, weights=v, minlength=len(found)) for v in values))


class Table:
    """Numbers looked up by key."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        self.keys, self.columns = keys, columns

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def _order(keys: np.ndarray, counts: np.ndarray, n: int, lower, discount: float = DISCOUNT) -> tuple[Table, Table]:
    """Interpolated probabilities of the n-grams with these counts, and what their contexts leave to lower orders."""
    contexts, total, taken = _summed(keys >> BITS, counts, np.minimum(counts, discount))
    left = Table(contexts, taken / total)
    at, _ = left.find(keys >> BITS)
    own = np.maximum(counts - discount, 0) / total[at] + left.columns[0][at] * lower(keys & ((1 << BITS * (n - 1)) - 1))
    return Table(keys, own), left


class Model:
    """Log-likelihoods of words under both classes. counts: 5-grams with documents that are toxic, ordinary, any.

    With ``held``, shared probabilities of some 4-grams, the lower orders are elsewhere: words with other 4-grams give NaN.
    """

    def __init__(
        self, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, every: np.ndarray, discount: float = DISCOUNT, held: Table | None = None
    ) -> None:
        self.held = held
        order = np.argsort(keys)
        keys, counts, every = keys[order], (toxic[order], ordinary[order]), every[order]
        self.shared: list[tuple[Table, Table]] = []
        grams = keys[every >= MIN_DOCS] if held is None else keys[:0]
        levels = []
        for n in range(ORDER - 1, 0, -1):  # continuation counts: kinds of (n+1)-grams that end in the n-gram
            grams, kinds = _summed(grams & ((1 << BITS * n) - 1), np.ones(len(grams)))
            levels.append((n, grams, kinds))
        self.letters = max(1, len(levels[-1][1]) if levels else 1)
        for n, grams, kinds in reversed(levels):
            self.shared.append(_order(grams, kinds, n, lambda low: self._shared(low, len(self.shared))))
        self.classes = [
            _order(keys[c > 0], c[c > 0], ORDER, lambda low: self._shared(low, ORDER - 1), discount) for c in counts
        ]

    def _shared(self, keys: np.ndarray, n: int) -> np.ndarray:
        """Shared probability of the last letter of n-grams."""
        if self.held is not None:
            at, there = self.held.find(keys)
            return np.where(there, self.held.columns[0][at], np.nan) if len(self.held.keys) else np.full(len(keys), np.nan)
        if n == 0:
            return np.full(len(keys), 1 / (self.letters + 1))
        return self._back(keys, n, *self.shared[n - 1], lambda low: self._shared(low, n - 1))

    @staticmethod
    def _back(keys, n, own: Table, left: Table, lower) -> np.ndarray:
        at, there = own.find(keys)
        out = np.empty(len(keys))
        out[there] = own.columns[0][at[there]] if len(own.keys) else 0.0
        rest = keys[~there]
        at, known = left.find(rest >> BITS)
        share = np.where(known, left.columns[0][at] if len(left.keys) else 1.0, 1.0)
        out[~there] = share * lower(rest & ((1 << BITS * (n - 1)) - 1))
        return out

    def holding(self, held: Table) -> Model:
        """The same model with the shared probabilities of other 4-grams."""
        other = copy.copy(self)
        other.held = held
        return other

    def word_likelihoods(self, words: list[str]) -> np.ndarray:
        """Rows: length with the end, log-likelihood if toxic, if ordinary."""
        if not words:
            return np.zeros((0, 3))
        grams, sizes = _letters(_plain(words))
        unlike, of = np.unique(grams, return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        logs = [
            np.add.reduceat(np.log(self._back(unlike, ORDER, *c, lambda low: self._shared(low, ORDER - 1)))[of], starts)
            for c in self.classes
        ]
        return np.column_stack([sizes, *logs])


class Reader:
    """Features of texts; remembers the likelihoods of words."""

    def __init__(self, model: Model) -> None:
        self.model, self.known, self.rows = model, {}, np.zeros((0, 3))

    def features(self, texts: list[str | None], more: list[dict | None] | None = None) -> np.ndarray:
        """Rows: log-likelihood per letter if toxic, if ordinary, then mean and peaks of their difference.

        ``more``: for each text the rows of ``word_likelihoods`` of the words that the model itself cannot judge.
        """
        out = [np.zeros((0, 5))]
        for start, split in self._split(texts):
            out.append(self._features(split, more[start : start + len(split)] if more else [None] * len(split)))
        return np.concatenate(out)

    def unjudged(self, texts: list[str | None]) -> list[list[str]]:
        """The distinct words of each text that have 4-grams the model does not hold."""
        out = []
        for _, split in self._split(texts):
            self._learn(split)
            for words in split:
                distinct = sorted(set(words))
                at = np.array([self.known[w] for w in distinct], dtype=np.int64)
                out.append([distinct[i] for i in np.flatnonzero(np.isnan(self.rows[at, 1:]).any(axis=1))])
        return out

    @staticmethod
    def _split(texts: list[str | None]) -> Iterator[tuple[int, list[list[str]]]]:
        """The words of a few texts at a time, and where those start."""
        start, size = 0, 0
        for i, x in enumerate(texts):
            size += len(x or "")
            if size >= CHUNK or i == len(texts) - 1:
                yield start, [words_of(x) for x in texts[start : i + 1]]
                start, size = i + 1, 0

    def _learn(self, split: list[list[str]]) -> None:
        new = list({w for words in split for w in words}.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.rows = {}, np.zeros((0, 3))
            new = list({w for words in split for w in words})
        self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.rows = np.concatenate([self.rows, self.model.word_likelihoods(new)])

    def _features(self, split: list[list[str]], more: list[dict | None]) -> np.ndarray:
        self._learn(split)
        out = np.zeros((len(split), 5))
        for i, words in enumerate(split):
            if words:
                rows = self.rows[[self.known[w] for w in words]]
                if more[i]:
                    for at in np.flatnonzero(np.isnan(rows[:, 1:]).any(axis=1)):
                        rows[at] = more[i][words[at]]
                sizes, toxic, ordinary = rows.T
                ratio = toxic - ordinary
                n = sizes.sum()
                top = np.partition(ratio, -min(3, len(ratio)))[-3:]
                out[i] = toxic.sum() / n, ordinary.sum() / n, ratio.sum() / n, min(top.max(), MOST), min(top.mean(), MOST)
        return out


def _scaled(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), features[:, 2] * 10, features[:, 3] / 4, features[:, 4] / 4])


def fit_curves(seen: DataFrame, models: int, penalty: float = 1.0, rounds: int = 25) -> list[tuple[np.ndarray, float]]:
    """Logistic regressions by Newton's method, one for each model, and their mean losses.

    ``seen``: toxic, and found, the features of a text under one model after the other; Spark sums over all of its rows.
    The rarer class weighs more, by the root of the ratio.
    """
    rows, bad = seen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < rows:
        return [(DEFAULT_CURVE, 0.0)] * models
    heavy, size = float(np.sqrt((rows - bad) / bad)), len(DEFAULT_CURVE)
    ridge = np.diag([1e-6] + [penalty] * (size - 1))

    def summed(betas: list[np.ndarray]) -> np.ndarray:
        """Rows: for each model the slope, the bend, the loss and the weight."""

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, size + size * size + 2))
            for batch in batches:
                y = batch.column("toxic").to_numpy().astype(float)
                found = batch.column("found").flatten().to_numpy().reshape(len(y), models, -1)
                weight = np.where(y == 1, heavy, 1.0)
                for m, beta in enumerate(betas):
                    x = _scaled(found[:, m])
                    p = _curve(x @ beta)
                    bend = (x * (weight * p * (1 - p))[:, None]).T @ x
                    loss = -(weight * np.log(np.where(y == 1, p, 1 - p))).sum()
                    total[m] += np.concatenate([x.T @ (weight * (y - p)), bend.ravel(), [loss, weight.sum()]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "value"])

        sums = seen.mapInArrow(each, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
        return sums.orderBy("place").toPandas()["value"].to_numpy().reshape(models, -1)

    betas = [np.zeros(size)] * models
    for _ in range(rounds):
        sums = summed(betas)
        steps = [np.linalg.solve(t[size:-2].reshape(size, size) + ridge, t[:size] - ridge @ b) for t, b in zip(sums, betas)]
        betas = [b + step for b, step in zip(betas, steps)]
        if max(np.abs(step).max() for step in steps) < 1e-9:
            break
    return [(b, float(t[-2] / t[-1])) for b, t in zip(betas, summed(betas))]


def _curve(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Scorer:
    """model and curve, or where a class has no labelled rows the score of everything.

    ``levels``: the lower orders of a model that does not hold them, see ``_levels``.
    """

    model: Model | None
    curve: np.ndarray
    constant: float = 0.0
    levels: list[tuple[DataFrame, DataFrame]] | None = None


def _labelled(labels: DataFrame, key: str, toxic: str, rows: int, curve_rows: int) -> dict:
    """Keys of a bounded sample of labelled rows -> (is for the curve, is toxic); bounded by the two numbers.

    A key with several labels is toxic if one says so. Null keys and other labels are left out.
    """
    fold = F.crc32(F.col("key").cast("string")) % FOLDS
    known = (
        pick(labels, key=key, toxic=toxic).where("key IS NOT NULL AND toxic IN (0, 1)").groupBy("key").agg(F.max("toxic").alias("toxic"))
        .where(fold != HELD_OUT).withColumn("curve", fold == CURVE).withColumn("place", F.xxhash64(F.lit("fit"), "key"))
    )
    found = {}
    for row in known.groupBy("curve", "toxic").count().collect():
        most = curve_rows if row.curve else rows
        span = min(1.0, 1.1 * most / row["count"])
        group = known.where((F.col("curve") == row.curve) & (F.col("toxic") == row.toxic))
        sample = group if span == 1 else group.where(F.col("place") < F.lit(int(-(2**63) + span * (2**64 - 2**12))))
        keys = sample.orderBy("place", "key").limit(most).select("key").collect()
        found |= {k.key: (row.curve, int(row.toxic)) for k in keys}
    return found


def _counted(rows: Iterator[pa.RecordBatch], known: dict) -> Iterator[pa.RecordBatch]:
    """Batches of key, text -> 5-gram, documents that are toxic, ordinary, any: sums of many texts."""
    counts = [Counter(), Counter(), Counter()]

    def handed() -> pa.RecordBatch:
        words = list(counts[2])
        grams, sizes = _letters(_plain(words))
        # A word's count goes to each of its 5-grams.
        per = [np.repeat(np.fromiter((c.get(w, 0) for w in words), dtype=np.int64, count=len(words)), sizes) for c in counts]
        keys, *sums = _summed(grams, per[1], per[0], per[2])
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(s.astype(np.int64)) for s in sums)], ["gram", "toxic", "ordinary", "every"])

    for batch in parts(rows):
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            words = set(words_of(text))
            counts[2].update(words)
            for_curve, toxic = known.get(key, (True, 0))
            if not for_curve:
                counts[toxic].update(words)
            if len(counts[2]) > COUNTED:
                yield handed()
    if counts[2]:
        yield handed()


def _tail(gram: Column, n: int) -> Column:
    """The last n letters of an n-gram's number."""
    return gram.bitwiseAND(F.lit((1 << BITS * n) - 1))


def _levels(sums: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Shared probabilities by order, from 1: (gram, docs, p) and (context, left), what a context leaves to the order below.

    As in ``Model``, for any number of n-grams. The first entry, of order 0, has the probability of a letter never seen.
    """
    above, counts = sums.select("gram", F.col("every").alias("docs")), {}
    for n in range(ORDER - 1, 0, -1):
        kinds = above.groupBy(_tail(F.col("gram"), n).alias("gram")).agg(F.count("*").alias("kinds"), F.sum("docs").alias("docs"))
        above = counts[n] = materialize(kinds, f"{n}-grams")
    base = counts[1].agg((1 / (F.greatest(F.count("*"), F.lit(1)) + 1)).alias("p")).withColumn("gram", F.lit(0).cast("long"))
    levels = [(materialize(base, "0-grams"), None)]
    for n in range(1, ORDER):
        per = counts[n].withColumn("context", F.shiftright("gram", BITS))
        left = per.groupBy("context").agg(
            F.sum("kinds").alias("total"), (F.sum(F.least("kinds", F.lit(DISCOUNT))) / F.sum("kinds")).alias("left")
        )
        left = materialize(left, "contexts")
        lower = levels[-1][0].select(F.col("gram").alias("tail"), F.col("p").alias("lower"))
        own = F.greatest(F.col("kinds") - DISCOUNT, F.lit(0.0)) / F.col("total") + F.col("left") * F.col("lower")
        joined = per.join(left, "context").join(lower, _tail(F.col("gram"), n - 1) == F.col("tail"))
        levels.append((materialize(joined.select("gram", "docs", own.alias("p")), "probabilities"), left.select("context", "left")))
    return levels


def _backed_off(grams: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """4-grams (gram) -> gram, p: the shared probability of the longest end that is known, less for each context on the way."""
    out = grams.select("gram", F.lit(1.0).alias("share"), F.lit(None).cast("double").alias("p"))
    for n in range(ORDER - 1, -1, -1):
        known, left = levels[n]
        tail = _tail(F.col("gram"), n)
        known = known.select(F.col("gram").alias("tail"), F.col("p").alias("own"))
        out = out.join(known, tail == F.col("tail"), "left").withColumn("p", F.coalesce("p", F.col("share") * F.col("own")))
        if left is not None:
            out = out.join(left, F.shiftright(tail, BITS) == F.col("context"), "left")
            out = out.withColumn("share", F.col("share") * F.coalesce("left", F.lit(1.0)))
        out = out.select("gram", "share", "p")
    return out.select("gram", "p")


def _judged(words: DataFrame, models: list[Model], levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Distinct words -> word, found: the rows of ``word_likelihoods`` under one model after the other."""
    sent = words.sparkSession.sparkContext.broadcast(models)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            if batch.num_rows:
                grams, sizes = _letters(_plain(batch.column("word").to_pylist()))
                at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
                tails = pa.array(grams & ((1 << BITS * (ORDER - 1)) - 1))
                yield pa.RecordBatch.from_arrays([batch.column("word").take(at), tails], ["word", "gram"])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            if batch.num_rows:
                given, names = batch.column("grams").flatten(), batch.column("word").to_pylist()
                keys, first = np.unique(given.field("gram").to_numpy(), return_index=True)
                held = Table(keys, given.field("p").to_numpy()[first])
                found = np.hstack([m.holding(held).word_likelihoods(names) for m in sent.value])
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("word"), lists], ["word", "found"])

    grams = materialize(words.mapInArrow(cut, "word string, gram long").distinct(), "grams-of-words")
    known = materialize(_backed_off(grams.select("gram").distinct(), levels), "backed-off")
    lists = grams.join(known, "gram").groupBy("word").agg(F.collect_list(F.struct("gram", "p")).alias("grams"))
    return lists.mapInArrow(weighed, "word string, found array<double>")


_MORE = "array<struct<word: string, found: array<double>>>"


def _completed(rows: DataFrame, text: str, models: list[Model], levels: list[tuple[DataFrame, DataFrame]] | None) -> DataFrame:
    """``rows`` with ``_more``: likelihoods of the words that the models, which hold the same 4-grams, cannot judge."""
    if levels is None:
        return rows.withColumn("_more", F.lit(None).cast(_MORE))
    sent = rows.sparkSession.sparkContext.broadcast(models[0])
    at = rows.columns.index(text)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in parts(batches):
            words = pa.array(reader.unjudged(batch.column(at).to_pylist()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, words], [*batch.schema.names, "_words"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # Rows are numbered as they are stored: a number made while reading might differ the next time.
    numbered = rows.mapInArrow(asked, f"{schema}, _words array<string>").withColumn("_row", F.monotonically_increasing_id())
    stored = materialize(numbered, "unjudged")
    each = stored.select("_row", F.explode("_words").alias("word"))
    judged = materialize(_judged(each.select("word").distinct(), models, levels), "judged-words")
    more = each.join(judged, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "found")).alias("_more"))
    return stored.drop("_words").join(more, "_row", "left").drop("_row")


def _more_of(batch: pa.RecordBatch, models: int) -> list[list[dict | None]]:
    """For each model and row the rows of further words, by word."""
    lists = batch.column("_more").to_pylist()
    return [[x and {w["word"]: w["found"][3 * m : 3 * m + 3] for w in x} for x in lists] for m in range(models)]


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic",
    rows: int = COUNT_ROWS, curve_rows: int = CURVE_ROWS, grams: int = MODEL_GRAMS,
) -> Scorer:
    """Learns from labelled rows whose crc32(key as text) leaves a remainder by 5 other than 0.

    ``grams`` says how much of the shared counts a task holds; the scores do not depend on it.
    """
    context = docs.sparkSession.sparkContext
    known = _labelled(labels, key, toxic, rows, curve_rows)
    classes = {is_toxic for _, is_toxic in known.values()}
    if len(classes) < 2:
        return Scorer(None, DEFAULT_CURVE, float(classes == {1}))
    shared = context.broadcast(known)
    texts = pick(docs, key=key, text=text)
    counted = texts.mapInArrow(lambda it: _counted(it, shared.value), "gram long, toxic long, ordinary long, every long")
    sums = counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("toxic", "ordinary", "every"))).where(f"every >= {MIN_DOCS}")
    sums = materialize(sums, "grams")
    # What labelled documents hold is bounded by them. The others have shared counts alone, which too many stay in Spark.
    ours = F.col("toxic") + F.col("ordinary") > 0
    few = sums.where(~ours).count() <= grams
    levels = None if few else _levels(sums)
    kept = (sums if few else sums.where(ours)).toPandas()
    counts = [kept[c].to_numpy(dtype=t) for c, t in (("gram", np.int64), ("toxic", float), ("ordinary", float), ("every", float))]
    held = None
    if levels:
        probable = levels[-1][0]
        tails = sums.where(ours).select(_tail(F.col("gram"), ORDER - 1).alias("gram")).distinct()
        often = probable.orderBy(F.desc("docs"), "gram").limit(grams)
        near = probable.join(tails, "gram", "left_semi").unionByName(often).select("gram", "p").distinct().orderBy("gram").toPandas()
        held = Table(near["gram"].to_numpy(dtype=np.int64), near["p"].to_numpy(dtype=float))
    models = [Model(*counts, discount=d, held=held) for d in CLASS_DISCOUNTS]
    sent = context.broadcast(models)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [shared.value.get(k, (False, 0)) for k in batch.column("key").to_pylist()]
            mine = [i for i, (for_curve, _) in enumerate(marks) if for_curve]
            toxic_ = pa.array([marks[i][1] for i in mine], type=pa.int64())
            yield pa.RecordBatch.from_arrays([toxic_, batch.column("text").take(pa.array(mine, type=pa.int64()))], ["toxic", "text"])

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(m) for m in sent.value]
        for batch in parts(batches):
            theirs = batch.column("text").to_pylist()
            found = np.hstack([r.features(theirs, more) for r, more in zip(readers, _more_of(batch, len(readers)))])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), lists], ["toxic", "found"])

    for_curve = _completed(texts.mapInArrow(marked, "toxic long, text string"), "text", models, levels)
    curves = fit_curves(materialize(for_curve.mapInArrow(seen, "toxic long, found array<double>"), "curve-rows"), len(models))
    best = min(range(len(models)), key=lambda i: curves[i][1])
    return Scorer(models[best], curves[best][0], levels=levels)


def score(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """key, score, toxic_per_letter and ordinary_per_letter of every row; or ``docs`` with ``score`` put last.

    Null and empty texts, and texts without letters, have no evidence: their score is the curve's at 0. Repeated
    rows stay repeated; an empty table gives no rows.
    """
    model, curve, constant = scorer.model, scorer.curve, scorer.constant
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    rows = docs.toDF(*(f"_{i}" for i in range(len(docs.columns)))) if keep else pick(docs, key=key, text=text)
    text_at = at if keep else 1
    kept = rows.schema.fields if keep else rows.schema.fields[:1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value) if sent.value else None
        for batch in parts(batches):
            found = reader.features(batch.column(text_at).to_pylist(), _more_of(batch, 1)[0]) if reader else np.zeros((batch.num_rows, 5))
            values = _curve(_scaled(found) @ curve) if reader else np.full(batch.num_rows, constant)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(values), pa.array(found[:, 0]), pa.array(found[:, 1])],
                [*(f.name for f in kept), "score", "toxic_per_letter", "ordinary_per_letter"],
            )

    rows = _completed(rows, rows.columns[text_at], [model], scorer.levels)
    out = rows.mapInArrow(scored, f"{schema}, score double, toxic_per_letter double, ordinary_per_letter double")
    return out.drop("toxic_per_letter", "ordinary_per_letter").toDF(*docs.columns, "score") if keep else out


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS == HELD_OUT


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    marked = score(docs.toDF(*names), fit(docs, labels, key, text), *(names[docs.columns.index(c)] for c in (key, text)), keep=True)
    return marked.where(F.col("score") < threshold).drop("score").toDF(*docs.columns)
