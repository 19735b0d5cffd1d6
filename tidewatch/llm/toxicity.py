"""Operator 2: toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over
the words and character n-grams that a text contains. The model of a category also takes
the probabilities of all earlier categories. It is trained on out-of-fold
ones (from models that have not seen the row), so that it meets the same kind
of probabilities as in use; in use they come from models of all training rows.

Features are 40-bit hashes; a document has a feature or not, whatever its
length. Texts are lower-cased in any script. Words are the runs of letters,
digits and code points beyond ASCII outside the general, Latin and CJK
punctuation blocks, so quotes, brackets and hyphens part them, and words of
any length up to ``LONGEST`` bytes are features as a whole. Within each run of
non-space characters, symbols included, all n-grams of ``GRAMS`` characters
are features, at every place of the run; of two characters only those that
begin beyond ASCII, for scripts without spaces. Candidates appear in
``MIN_DOCS`` positive training rows of a category at least; of all of them
the ``FEATURES`` words and the ``GRAM_FEATURES`` n-grams with the highest
chi-squared of each category are kept (the size of the model; n-grams apart,
as the many parts of a few telling words would take all places).
Training takes the
``TRAIN_ROWS`` labelled documents with the smallest hashes of their ids (a
documented bound, so the driver fits the models in memory); scoring covers
all documents, whole texts, in one pass without an exchange.

A category's cutoff is the one with the best F1 on out-of-fold probabilities.

Defined cases: null and empty texts have no features and get the categories'
base rates (never flagged: without a feature ``flag`` is false); labels that
are null, unknown or repeated count as no label, none, and their largest;
without labelled rows of both kinds a category's probability is its base rate
and nothing is flagged; repeated rows are scored one by one; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .shingles import _LETTER, _PLACE, _SPACE, mix, text_bytes

GRAMS = (2, 3, 4, 5)
LONGEST = 64
TRAIN_ROWS = 8000
FEATURES = 1000
GRAM_FEATURES = 200
MIN_DOCS = 5
FOLDS = 5
L2 = 1.0
ROUNDS = 150
_CHUNK = 2 << 20
_BLOCK = 1 << 18
_GRAM = np.uint64(1 << 39)  # tells the hashes of n-grams from those of words
_NEAR = LONGEST + 4 * max(GRAMS)  # bytes after a feature's first that it may need
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BACK = np.uint64(pow(int(_PLACE), -1, 1 << 64))


def _block(raw: np.ndarray, word: np.ndarray, before: bool, last: int, powers: np.ndarray, backs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, place) of the features that begin under ``last``; word:
    whether each byte belongs to a word, before: the byte before them. Hashes
    of runs of bytes are differences of the sums of all bytes' terms, brought
    back to the power of a run's first place."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[raw] * powers[:n], out=sums[1:])

    def hashed(at: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        found = mix((sums[end] - sums[at]) * backs[at] + np.uint64(kind)) >> np.uint64(25)
        return found | _GRAM if kind else found

    starts = (raw & 0xC0) != 0x80
    begins = word & ~np.append(before, word[:-1])
    ends = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
    at = np.flatnonzero(begins[:last])
    end = ends[np.searchsorted(ends, at, side="right")] if len(at) else at
    fits = end - at <= LONGEST
    out, places = [hashed(at[fits], end[fits], 0)], [at[fits]]
    chars = np.append(np.flatnonzero(starts), n)
    space = np.append(np.flatnonzero(_SPACE[raw]), n)
    run_end = space[np.searchsorted(space, chars[:-1])]
    own = chars[:-1] < last
    for k in GRAMS:
        if len(chars) <= k:
            break
        first, end = chars[:-k], chars[k:]
        use = own[:len(first)] & (end <= run_end[:len(first)])
        if k == 2:
            use &= raw[first] >= 0x80
        out.append(hashed(first[use], end[use], k))
        places.append(first[use])
    return np.concatenate(out), np.concatenate(places)


def _word_bytes(raw: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to a word."""
    word = _WORD[raw]
    high = np.flatnonzero(raw >= 0xC2)
    second = raw[np.minimum(high + 1, len(raw) - 1)]
    two = high[(raw[high] == 0xC2) & (second >= 0xA0)]  # U+00A0 to U+00BF
    three = high[((raw[high] == 0xE2) & (second <= 0x81)) | ((raw[high] == 0xE3) & (second == 0x80))]  # U+2000 to U+207F, U+3000 to U+303F
    for at, size in ((two, 2), (three, 3)):
        for k in range(size):
            word[np.minimum(at + k, len(raw) - 1)] = False
    return word


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of all words and n-grams of lower-cased texts, repeats
    included."""
    found = list(_features(texts))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([f for f, _ in found]), np.concatenate([r for _, r in found])


def _features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same block by block, so that a long text takes bounded memory."""
    raw, offsets = text_bytes(texts)
    raw = np.insert(raw, offsets[1:], np.uint8(32))  # a space after each text, so that a block may hold many
    firsts = offsets[:-1] + np.arange(len(texts))
    powers, backs = (np.cumprod(np.full(min(_BLOCK + _NEAR, len(raw)) + 1, x), dtype=np.uint64) for x in (_PLACE, _BACK))
    for start in range(0, len(raw), _BLOCK):
        back = min(start, 4)  # a code point's bytes before the block
        near = raw[start - back:start + _BLOCK + _NEAR]
        word = _word_bytes(near)
        feature, place = _block(near[back:], word[back:], bool(back and word[back - 1]), min(_BLOCK, len(near) - back), powers, backs)
        yield feature, np.searchsorted(firsts, place + start, side="right") - 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows (text last) of bounded bytes."""
    for b in batches:
        sizes = np.append(0, np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in b.columns[-1].cast(pa.binary())]))
        at = 0
        while at < len(b):
            end = min(max(int(np.searchsorted(sizes, sizes[at] + _CHUNK, side="right")) - 1, at + 1), len(b))
            yield b.slice(at, end - at)
            at = end


class Kept:
    """Sorted features of a model; a table of their low bits passes what may
    be one of them."""
    BITS = np.uint64((1 << 20) - 1)

    def __init__(self, kept: np.ndarray):
        self.kept = kept
        self.maybe = np.zeros(int(self.BITS) + 1, bool)
        self.maybe[(kept & self.BITS).astype(np.int64)] = True

    def distinct(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, number of the feature), each once, sorted."""
        found = []
        for feature, row in _features(texts) if len(self.kept) else ():
            some = np.flatnonzero(self.maybe[(feature & self.BITS).astype(np.int64)])
            feature, row = feature[some], row[some]
            at = np.minimum(np.searchsorted(self.kept, feature), len(self.kept) - 1)
            hit = self.kept[at] == feature
            found.append(np.unique(row[hit] * len(self.kept) + at[hit]))
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return both // max(len(self.kept), 1), both % max(len(self.kept), 1)


def _counted(n_labels: int):
    """Of each chunk of rows: its features, the rows that have each, and
    those of them that are positive, by category."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            labels = np.array(b.column(0).to_pylist(), dtype=np.int64).reshape(len(b), n_labels)
            # a feature has 40 bits, a row of a batch fewer than 24
            both = [np.unique(feature << np.uint64(24) | row.astype(np.uint64)) for feature, row in _features(b.columns[-1])]
            both = np.unique(np.concatenate(both)) if both else np.zeros(0, np.uint64)
            feature, row = both >> np.uint64(24), (both & np.uint64((1 << 24) - 1)).astype(np.int64)
            at = np.flatnonzero(np.append(True, feature[1:] != feature[:-1])) if len(feature) else np.zeros(0, np.int64)
            counts = [np.add.reduceat(x, at) if len(at) else np.zeros(0, np.int64) for x in (np.ones(len(row), np.int64), *labels[row].T)]
            yield pa.RecordBatch.from_arrays([pa.array(feature[at].astype(np.int64)), *map(pa.array, counts)],
                                             names=["feature", "n", *(f"n{i}" for i in range(n_labels))])
    return run


def _present(kept: Kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            rows, numbers = kept.distinct(b.columns[-1])
            cuts = np.searchsorted(rows, np.arange(len(b) + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([numbers[i:j].astype(np.int32) for i, j in zip(cuts, cuts[1:], strict=False)], pa.list_(pa.int32()))],
                                             names=["labels", "present"])
    return run


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Linear:
    """Logistic regression on a sparse 0/1 matrix and a few dense columns."""
    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def logits(self, rows: np.ndarray, cols: np.ndarray, n: int, dense: np.ndarray) -> np.ndarray:
        return np.bincount(rows, self.sparse[cols], n) + dense @ self.dense + self.bias


def fit(rows: np.ndarray, cols: np.ndarray, n_cols: int, dense: np.ndarray, y: np.ndarray) -> Linear:
    """Nesterov's method on the L2-regularised log loss, with per-column
    steps; a constant model where y has one value only."""
    n = len(y)
    rate = (y.sum() + 0.5) / (n + 1)
    model = Linear(np.zeros(n_cols), np.zeros(dense.shape[1]), float(np.log(rate / (1 - rate))))
    if not 0 < y.sum() < n:
        return model
    per_row = np.bincount(rows, minlength=n) + 1 + np.abs(dense).sum(axis=1)
    step = 1 / (np.bincount(cols, per_row[rows], n_cols) / 4 + L2)  # a bound on each column's curvature
    step_d = 1 / ((per_row[:, None] * np.abs(dense)).sum(axis=0) / 4 + L2)
    step_b = 4 / per_row.sum()
    w, d, b = model.sparse.copy(), model.dense.copy(), model.bias
    v = (w, d, b)
    for t in range(ROUNDS):
        gap = sigmoid(Linear(*v).logits(rows, cols, n, dense)) - y
        new = (v[0] - step * (np.bincount(cols, gap[rows], n_cols) + L2 * v[0]),
               v[1] - step_d * (dense.T @ gap + L2 * v[1]), v[2] - step_b * gap.sum())
        pull = t / (t + 3)
        v = tuple(x + pull * (x - o) for x, o in zip(new, (w, d, b), strict=True))
        w, d, b = new
    return Linear(w, d, float(b))


@dataclass
class Chain:
    categories: list[str]
    kept: np.ndarray
    models: list[Linear] = field(default_factory=list)
    cutoffs: list[float] = field(default_factory=list)

    def probabilities(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for m in self.models:
            out = np.column_stack([out, sigmoid(m.logits(rows, cols, n, out))])
        return out


def _best_cutoff(p: np.ndarray, y: np.ndarray) -> float:
    """The cutoff with the best F1, midway to the next lower probability."""
    if not 0 < y.sum() < len(y):
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][1:] == p[order][:-1]] = 0  # equal probabilities go together
    k = int(np.argmax(f1))
    return float((p[order][k] + (p[order][k + 1] if k + 1 < len(p) else 0)) / 2)


def train(categories: Sequence[str], kept: np.ndarray, rows: np.ndarray, cols: np.ndarray, labels: np.ndarray) -> Chain:
    """labels: a 0/1 column per category. rows, cols: the features present."""
    n = len(labels)
    fold = np.arange(n) % FOLDS
    chain = Chain(list(categories), kept)
    earlier = np.zeros((n, 0))
    for c in range(len(categories)):
        y = labels[:, c].astype(float)
        out_of_fold = np.zeros(n)
        for k in range(FOLDS):
            inside, held = fold != k, fold == k
            at = np.cumsum(inside) - 1
            use = inside[rows]
            model = fit(at[rows[use]], cols[use], len(kept), earlier[inside], y[inside])
            out_of_fold += np.where(held, sigmoid(model.logits(rows, cols, n, earlier)), 0)
        chain.models.append(fit(rows, cols, len(kept), earlier, y))
        chain.cutoffs.append(_best_cutoff(out_of_fold, y))
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


def select_features(sample: DataFrame, n_labels: int, words: int = FEATURES, grams: int = GRAM_FEATURES) -> np.ndarray:
    """Of words and of n-grams, the features with the highest chi-squared of
    each category, sorted (of equals the smaller); sample: labels, text."""
    n, *pos = sample.agg(F.count("*"), *[F.coalesce(F.sum(F.get("labels", F.lit(i))), F.lit(0)) for i in range(n_labels)]).first()
    sums = sample.mapInArrow(_counted(n_labels), ", ".join(["feature long", "n long", *(f"n{i} long" for i in range(n_labels))]))
    sums = sums.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(n_labels)])
    sums = staged(sums.where(F.greatest(*[f"n{i}" for i in range(n_labels)], F.lit(0)) >= MIN_DOCS), "toxicity-features")
    have = F.col("n").cast("double")

    def chi2(i: int) -> Column:
        with_pos, p = F.col(f"n{i}").cast("double"), F.lit(float(pos[i]))
        under = have * (n - have) * p * (n - p)
        return F.when(under > 0, n * (with_pos * n - have * p) * (with_pos * n - have * p) / under).otherwise(0.0)
    kept = set()
    for i in range(n_labels):
        for kind, most in ((F.col("feature") < int(_GRAM), words), (F.col("feature") >= int(_GRAM), grams)):
            kept.update(r[0] for r in sums.where(kind).select("feature", chi2(i).alias("chi2")).orderBy(F.desc("chi2"), "feature").limit(most).collect())
    return np.array(sorted(kept), dtype=np.uint64)


def train_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], text: str = "text", key: str = "doc_id",
                train_rows: int = TRAIN_ROWS) -> Chain:
    """A chain over ``categories`` (name: condition on the columns of
    ``labels``), in their order."""
    truth = labels.select(F.col(key).alias("__key"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
    truth = truth.where(F.col("__key").isNotNull()).groupBy("__key").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))])
    whole = F.array(*[f"y{i}" for i in range(len(categories))])
    truth = truth.where(~F.exists(whole, lambda y: y.isNull())).select("__key", whole.alias("labels"))
    chosen = staged(docs.select(F.col(key).alias("__key")).distinct().join(truth, "__key")
                    .orderBy(F.xxhash64("__key"), "__key").limit(train_rows), "toxicity-chosen")
    sample = docs.select(F.col(key).alias("__key"), _lowered(text).alias("text")).join(F.broadcast(chosen), "__key")  # train_rows ids
    sample = staged(sample.dropDuplicates(["__key"]).select("labels", "text"), "toxicity-sample")
    kept = select_features(sample, len(categories))
    got = sample.mapInArrow(_present(Kept(kept)), "labels array<int>, present array<int>").toArrow().combine_chunks()
    truth_of = np.array(got.column("labels").to_pylist(), dtype=int).reshape(len(got), len(categories))
    present = pa.concat_arrays(got.column("present").chunks) if len(got) else pa.array([], pa.list_(pa.int32()))
    cols = present.flatten().to_numpy().astype(np.int64)
    rows = np.repeat(np.arange(len(present)), present.value_lengths().to_numpy())
    return train(list(categories), kept, rows, cols, truth_of)


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text), F.lit("")))


def _scorer(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"p_{c}" for c in chain.categories), *chain.categories]
        kept = Kept(chain.kept)
        for b in _chunks(batches):
            n = len(b)
            rows, cols = kept.distinct(b.columns[-1])
            p = chain.probabilities(rows, cols, n)
            some = np.bincount(rows, minlength=n) > 0
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in p.T),
                                              *(pa.array((p[:, i] >= c) & some) for i, c in enumerate(chain.cutoffs))], names=names)
    return run


def score(docs: DataFrame, chain: Chain, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, p_<category> and the flag
    <category> for each category."""
    schema = ", ".join(["doc_id long", *(f"p_{c} double" for c in chain.categories), *(f"{c} boolean" for c in chain.categories)])
    return docs.select(F.col(key).cast("long").alias("doc_id"), _lowered(text).alias("text")).mapInArrow(_scorer(chain), schema)
