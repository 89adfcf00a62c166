"""Toxicity: bags of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at its ends) and itself, each a
row of a hashed embedding table, so that unseen misspellings and inflections share the
vectors of their n-grams. A window of words is the average of its words. The softmax of a
document is that of its most toxic window; the first epoch trains on whole documents as one
window, the others on the window that the model finds most toxic, for both labels.

The bias is the log odds of the labels, so that a text of unknown words, or of none, gets
the share of toxic labels. Two classes make the softmax a logistic function of one margin. The trained table is then
folded with the output weights into one number per n-gram for scoring.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.batches import cuts, pieces, strings

#: Labelled documents of each label that are used for training, those with the smallest hash of their id.
TRAINING_ROWS = 4000
BUCKETS_LOG2 = 18
DIMENSIONS = 8
GRAMS = (3, 4, 5, 6)
WINDOW, STEP = 16, 8
EPOCHS = 12
BATCH = 32
#: Longer words are taken in pieces.
LONGEST_WORD = 64
#: Words kept with their scores in a worker; when there are more, the store starts anew.
KNOWN_WORDS = 150_000
#: Words whose n-grams are made at a time; those of all words of a piece of text would need much memory.
WORDS = 20_000
#: Scores from here on are toxic.
THRESHOLD = 0.3

WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)  # odd multipliers


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams of the words, and the word that each belongs to."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    shift = np.uint64(64 - BUCKETS_LOG2)
    power = np.cumprod(np.full(LONGEST_WORD + 2, _STEP, dtype=np.uint64))
    whole = np.add.reduceat(codes * power[np.arange(len(codes)) - starts[owner]], starts) if len(words) else codes
    rows, of = [((whole ^ (whole >> np.uint64(31))) * _MIX) >> shift], [np.arange(len(words))]
    for n in GRAMS:
        if len(codes) < n:
            break
        last = len(codes) - n + 1
        gram = np.full(last, n, dtype=np.uint64)
        for j in range(n):
            gram = (gram ^ codes[j : last + j]) * _STEP
        inside = owner[:last] == owner[n - 1 :]
        gram = gram[inside]
        rows.append(((gram ^ (gram >> np.uint64(31))) * _MIX) >> shift)
        of.append(owner[:last][inside])
    return np.concatenate(rows).astype(np.int64), np.concatenate(of)


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows over n words: every STEP words, and the last WINDOW words."""
    if n <= WINDOW:
        return np.array([0]), np.array([n])
    starts = np.append(np.arange(0, n - WINDOW, STEP), n - WINDOW)
    return starts, starts + WINDOW


def worst(scores: np.ndarray) -> tuple[float, int, int]:
    """Mean of the window with the highest mean of word scores, its start and end."""
    if not len(scores):
        return 0.0, 0, 0
    fresh = np.concatenate([[True], scores[1:] != scores[:-1]])  # a word said again at once counts once
    if not fresh.all():
        places = np.append(np.flatnonzero(fresh), len(scores))
        mean, a, b = worst(scores[fresh])
        return mean, int(places[a]), int(places[b])
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    a, b = windows(len(scores))
    means = (total[b] - total[a]) / (b - a)
    k = int(means.argmax())
    return float(means[k]), int(a[k]), int(b[k])


@dataclass
class Model:
    """Margin of toxic over clean: ``bias`` and the mean of the words' mean ``weights``."""

    weights: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        rows, of = subwords(words)
        count = np.bincount(of, minlength=len(words))
        return np.bincount(of, weights=self.weights[rows], minlength=len(words)) / np.maximum(count, 1)

    def scores(self, texts: list[str], known: dict[str, float]) -> list[float]:
        """Probability of each text to be toxic; ``known`` collects the scores of words."""
        found = [[w for part in cuts(t) for w in words_of(part)] for t in texts]
        if len(known) > KNOWN_WORDS:
            known.clear()
        new = list({w for ws in found for w in ws}.difference(known))
        for k in range(0, len(new), WORDS):
            known.update(zip(new[k : k + WORDS], self.word_scores(new[k : k + WORDS]).tolist()))
        out = []
        for ws in found:
            mean, _, _ = worst(np.fromiter(map(known.__getitem__, ws), dtype=np.float64, count=len(ws)))
            out.append(1 / (1 + float(np.exp(-np.clip(mean + self.bias, -30, 30)))))
        return out


def trained(texts: list[str], labels: list[int], share: float | None = None, epochs: int = EPOCHS, seed: int = 17) -> Model:
    """Embeddings and output weights fitted together by Adagrad on small batches.

    ``share`` is the share of toxic labels where texts come from (default: that of ``labels``).
    """
    size = 1 << BUCKETS_LOG2
    if not texts or not 0 < sum(labels) < len(labels):  # nothing to tell apart
        return Model(np.zeros(size, dtype=np.float32), 30.0 if labels and all(labels) else -30.0)
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], dtype=np.int32) for t in texts]
    names, parts, counts = list(number), [], []
    for k in range(0, len(names), WORDS):
        found, of = subwords(names[k : k + WORDS])
        parts.append(found[np.argsort(of, kind="stable")].astype(np.int32))
        counts.append(np.bincount(of))
    rows, count = np.concatenate(parts), np.concatenate(counts)
    first = np.cumsum(count) - count
    del number, names, parts, counts
    # small vectors and a large output layer: an average over a window leaves little of one word
    table = rng.uniform(-1 / 64, 1 / 64, (size, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, 8, DIMENSIONS).astype(np.float32)
    share = sum(labels) / len(labels) if share is None else share
    bias = float(np.log(share / (1 - share)))
    seen, seen_output = np.full(size, 1e-3, dtype=np.float32), 1e-3
    truth = np.array(labels, dtype=np.float64)
    weight = np.where(truth > 0, 0.5 / truth.mean(), 0.5 / (1 - truth.mean()))  # both labels weigh the same
    bags = docs
    for epoch in range(epochs):
        rate = 0.3 * (1 - epoch / epochs)
        if epoch:
            word_scores = np.add.reduceat((table @ output)[rows], first) / count
            bags = [ids[slice(*worst(word_scores[ids])[1:])] for ids in docs]
        for batch in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            lengths = np.array([len(bags[k]) for k in batch])
            ids = np.concatenate([bags[k] for k in batch])
            doc = np.repeat(np.arange(len(batch)), lengths)
            mine = _rows(rows, first, count, ids)
            part = np.repeat(1 / (count[ids] * np.maximum(lengths, 1)[doc]), count[ids]).astype(np.float32)
            whose = np.repeat(doc, count[ids])
            touched, slot = np.unique(mine, return_inverse=True)
            folded = table[touched] @ output
            margin = np.bincount(whose, weights=folded[slot] * part, minlength=len(batch)) + bias
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - truth[batch]) * weight[batch]
            # gradient of a table row: sum of parts and slopes times the output weights
            pull = np.bincount(slot, weights=part * slope[whose], minlength=len(touched)).astype(np.float32)
            grow = pull @ table[touched]
            seen[touched] += pull**2 * float(output @ output)
            table[touched] -= (rate * pull / np.sqrt(seen[touched]))[:, None] * output
            seen_output += float(grow @ grow)
            output -= 0.1 * rate * grow / np.sqrt(seen_output)
    return Model((table @ output).astype(np.float32), bias)


def _rows(rows: np.ndarray, first: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The table rows of several words, one after the other."""
    sizes = count[ids]
    return rows[np.arange(sizes.sum()) + np.repeat(first[ids] - (np.cumsum(sizes) - sizes), sizes)]


def held_out(id) -> F.Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    rows: int = TRAINING_ROWS,
) -> Model:
    """A model learned from at most ``rows`` labelled documents of each label that are not held out.

    Of these, whole texts are used; one task holds them, and the driver gets the weights.
    """
    marked = labels.select(labels[id].alias("id"), labels[label].cast("int").alias("label"))
    marked = marked.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    order = [F.xxhash64("id"), "id"]
    sample = marked.filter("label = 1").orderBy(*order).limit(rows).unionByName(
        marked.filter("label = 0").orderBy(*order).limit(rows))
    known = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    share = known.get(1, 0) / max(1, sum(known.values()))
    have = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    found = have.join(F.broadcast(sample), "id").orderBy("id", "label", "text").limit(2 * rows)
    fitted = found.select("text", "label").mapInArrow(_fit(share), "weights binary, bias double").collect()
    if not fitted:  # no partition, no task
        return trained([], [], share)
    return Model(np.frombuffer(fitted[0].weights, dtype=np.float32), fitted[0].bias)


def _fit(share: float):
    """The model of a task's rows; the limit before leaves them all to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += strings(batch)
            labels += batch.column("label").to_pylist()
        model = trained(texts, labels, share)
        columns = [pa.array([model.weights.astype(np.float32).tobytes()], pa.binary()), pa.array([float(model.bias)])]
        yield pa.RecordBatch.from_arrays(columns, names=["weights", "bias"])

    return run


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id`` and ``score``, the probability that its most toxic window is toxic.

    Null and empty texts, and texts without letters, get the score of the bias alone.
    Repeated rows are scored one by one; an empty table gives an empty result; other
    columns are left out.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store: dict[str, float] = {}
        for batch in pieces(batches):
            scores = pa.array(known.value.scores(strings(batch), store), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), scores], names=[id, "score"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below ``threshold``; all columns stay."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store: dict[str, float] = {}
        for batch in pieces(batches, text):
            scores = known.value.scores(strings(batch, text), store)
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
