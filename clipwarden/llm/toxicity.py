"""Toxicity by a subsequence string kernel on words, a support vector machine and Nyström landmarks.

The kernel counts common subsequences of three characters, spread over at most `REACH` further characters and
weighed down by `DECAY` for every character skipped, so `id-iot` and `idxiot` still share most of `idiot`, and
with two characters between all letters (`i--d--i--o--t`) its neighbouring letters still meet. All signs are one
character to the kernel.
Landmarks are labelled words; K(x, landmarks) K(landmarks)^(-1/2) are a word's Nyström features, and a linear
machine with squared hinge loss is trained on them. Its decision is a weighted sum of kernels, hence of
subsequences: for scoring it is folded into one table of weights per subsequence, which is exact.

Training words come from labelled sentences: words of sentences in toxic texts that clean texts lack, also
with characters inserted, against words of clean sentences, and in a second round those clean words that the
first machine scored highest, and joins of neighbouring ones. A text is judged by its words and by all runs of
neighbouring words that, joined, are no longer than the longest toxic training word (`i d i o t`, `id iot`): by the
highest margin, and by the highest one that shares no word with it, at least the second highest of single words. As a
long text has thousands of joins, one counts only above a floor that `CLEAN_JOINS` of the clean training texts stay
below with all of theirs. A logistic curve of both, fitted on the training texts, turns them into a score.

Bounds: at most `MAX_TEXTS` labelled texts (those of the least id hashes), `MAX_WORDS` training words of each
kind and `LANDMARKS` landmarks are used. All texts are scored whole.

Defined results: null and empty texts have the lowest margins; a text of one word has that word's margin twice;
texts score 0 without labels of both kinds to learn from, or words to tell them by; repeated rows give repeated results; an empty table gives an empty
result. Other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwarden.llm.common import id_and_text, stored

MAX_TEXTS, MAX_WORDS, LANDMARKS = 12_000, 2_000, 384
REACH, DECAY = 6, 0.6
CLASSES = 97
BEGIN, END = 95, 96
#: A toxic word may occur in one clean sentence for so many toxic ones.
CLEAN_SHARE = 20
CLEAN_JOINS = 0.999
LOWEST = -4.0
BLOCK_BYTES = 1 << 19
AFFIXES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
SIGNS = np.array([ord("-") if chr(c) in AFFIXES else c % (CLASSES - 2) for c in range(128)], np.int64)


def words_of(text: str) -> list[str]:
    """Lower-cased runs between white space; `plain` takes the punctuation off their ends."""
    return text.lower().split()


def plain(word: str) -> str:
    return word.strip(AFFIXES)


def classes(text: str) -> np.ndarray:
    """The kernel's characters: code points by remainder, signs as one."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, SIGNS[np.minimum(codes, 127)], codes % (CLASSES - 2)).astype(np.int64)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of all words, subsequences as numbers."""
    owner, found, weight = [], [], []
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.empty(int(lengths.sum()), np.int64)
    ends = np.cumsum(lengths)
    inner = np.ones(len(codes), bool)
    inner[ends - 1] = inner[ends - lengths] = False
    codes[inner] = classes("".join(words))
    codes[ends - lengths], codes[ends - 1] = BEGIN, END
    row = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(codes))
    for second in range(1, REACH):
        for third in range(second + 1, REACH + 1):
            at = np.flatnonzero(left > third)
            owner.append(row[at])
            found.append((codes[at] * CLASSES + codes[at + second]) * CLASSES + codes[at + third])
            weight.append(np.full(len(at), DECAY ** (third - 2)))
    return np.concatenate(owner), np.concatenate(found), np.concatenate(weight)


def norms(owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(owner, weight * weight, n), 1e-9))


def margins(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's decision on each word."""
    if not words:
        return np.zeros(0)
    owner, found, weight = subsequences(words)
    return np.bincount(owner, weight * table[found], len(words)) / norms(owner, weight, len(words)) + bias


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel of each word with each landmark."""
    owner, found, weight = subsequences(words)
    size = norms(owner, weight, len(words))
    own, theirs, heavy = subsequences(landmarks)
    scale = norms(own, heavy, len(landmarks))
    out = np.empty((len(words), len(landmarks)))
    table = np.zeros(CLASSES**3)
    for j in range(len(landmarks)):
        mine = own == j
        np.add.at(table, theirs[mine], heavy[mine])
        out[:, j] = np.bincount(owner, weight * table[found], len(words)) / size / scale[j]
        table[theirs[mine]] = 0
    return out


def pick_landmarks(words: list[str], n: int) -> list[str]:
    """Half of the landmarks from the head of the list, half evenly from the rest."""
    head, rest = words[: n // 2], words[n // 2 :]
    return head + [rest[i] for i in np.unique(np.linspace(0, len(rest) - 1, n - n // 2).astype(int))] if rest else head


def train_machine(
    toxic: list[str], clean: list[str], weight: list[float] | None = None, cost: float = 2000.0
) -> tuple[np.ndarray, float]:
    """Weights per subsequence and bias of the machine trained on words of both kinds.

    Words come in the order of their importance; `weight` says how much each toxic word counts.
    """
    half = LANDMARKS // 2
    landmarks = pick_landmarks(toxic, half) + pick_landmarks(clean, half)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = kernel(toxic + clean, landmarks) @ root
    y = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    heavy = np.ones(len(toxic)) if weight is None else np.asarray(weight, float)
    share = np.concatenate((0.5 * heavy / heavy.sum(), np.full(len(clean), 0.5 / len(clean)))) * len(y)
    w = np.zeros(x.shape[1] + 1)
    x1 = np.hstack((x, np.ones((len(x), 1))))
    for _ in range(30):  # Newton steps on the squared hinge loss
        short = np.maximum(0.0, 1 - y * (x1 @ w))
        active = short > 0
        grad = np.append(w[:-1], 0.0) - 2 * cost * (x1[active].T @ (share * y * short)[active]) / len(y)
        hess = np.diag(np.append(np.ones(len(w) - 1), 1e-6))
        hess += 2 * cost * (x1[active].T * share[active]) @ x1[active] / len(y)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    beta = root @ w[:-1]
    owner, found, weight = subsequences(landmarks)
    scale = norms(owner, weight, len(landmarks))
    table = np.zeros(CLASSES**3)
    np.add.at(table, found, weight * beta[owner] / scale[owner])
    return table, float(w[-1])


@dataclass(frozen=True)
class Model:
    """Weights per subsequence, bias, length and floor of joins, and the logistic curve from the two margins to scores."""

    table: np.ndarray
    bias: float
    longest: int
    floor: float
    curve: tuple[float, float, float]


def slices(batch: pa.RecordBatch, at: int = 1) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `BLOCK_BYTES` of text."""
    sizes = np.array([len(t or "") for t in batch.column(at).to_pylist()], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_BYTES, prepend=0)).tolist()
    edges = sorted({0, *cuts, batch.num_rows})
    for a, z in zip(edges[:-1], edges[1:]):
        yield batch.slice(a, z - a)


class Spans:
    """Margins of words and of joins of neighbouring words of some texts, from running sums over their characters."""

    def __init__(self, texts: list[str], table: np.ndarray, bias: float) -> None:
        words = [[plain(w) for w in words_of(t)] for t in texts]
        self.counts = np.array([len(w) for w in words], np.int64)
        self.words = [w for some in words for w in some]
        self.bias, self.table = bias, table
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        # no window reads the padding behind the last character: what reaches over an end is left out
        self.codes = codes = np.concatenate((classes("".join(self.words)), np.zeros(REACH, np.int64)))
        n = len(codes) - REACH
        first, pair = codes[:n] * CLASSES**2, codes * CLASSES
        before = self.codes[np.maximum(self.ends[:, None] - np.arange(REACH + 1), 0)]
        self.sums, self.heads, self.tails = [], [], []
        for third in range(2, REACH + 1):
            inner, head, tail = np.zeros(n), np.zeros(len(lengths)), np.zeros(len(lengths))
            for second in range(1, third):
                inner += table[first + pair[second : n + second] + codes[third : n + third]]
                head += table[BEGIN * CLASSES**2 + pair[self.starts + second - 1] + codes[self.starts + third - 1]]
                tail += table[before[:, third] * CLASSES**2 + before[:, third - second] * CLASSES + END]
            weight = DECAY ** (third - 2)
            self.sums.append(np.concatenate(([0.0], np.cumsum(inner * weight))))
            self.heads.append(head * weight)
            self.tails.append(tail * weight)

    def margins(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The machine's decision on the joins of the words from `first` to `last`."""
        start, end = self.starts[first], self.ends[last]
        length = end - start
        total, square = np.zeros(len(first)), np.zeros(len(first))
        for third, sums, head, tail in zip(range(2, REACH + 1), self.sums, self.heads, self.tails):
            total += sums[np.maximum(end - third, start)] - sums[start]
            total += np.where(length >= third, head[first] + tail[last], 0.0)
            square += np.maximum(length + 2 - third, 0) * ((third - 1) * DECAY ** (2 * third - 4))
            whole = np.flatnonzero(length == third - 1)  # from BEGIN to END
            for second in range(1, third):
                middle = self.codes[start[whole] + second - 1]
                total[whole] += self.table[(BEGIN * CLASSES + middle) * CLASSES + END] * DECAY ** (third - 2)
        return total / np.sqrt(np.maximum(square, 1e-9)) + self.bias

    def joins(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First and last word of all runs of two words and more, up to `longest` characters; words of signs only stand in none."""
        real = np.flatnonzero(self.ends > self.starts)
        owner, start, end = self.owner[real], self.starts[real], self.ends[real]
        at = np.arange(len(real))
        for more in range(1, longest):
            at = at[at + more < len(real)]
            at = at[(owner[at] == owner[at + more]) & (end[at + more] - start[at] <= longest)]
            if not len(at):
                return
            yield real[at], real[at + more]

    def join(self, first: int, last: int) -> str:
        return "".join(self.words[first : last + 1])

    def highest_join(self, longest: int) -> np.ndarray:
        """The highest margin of each text's joins."""
        out = np.full(len(self.counts), LOWEST)
        for first, last in self.joins(longest):
            np.maximum.at(out, self.owner[first], self.margins(first, last))
        return out

    def two_highest(self, longest: int, floor: float) -> np.ndarray:
        """best and second of each text."""
        out = np.full((2, len(self.counts)), LOWEST)
        if not self.words:
            return out
        every = np.arange(len(self.words))
        single = self.margins(every, every)
        order = np.lexsort((single, self.owner))
        filled = np.flatnonzero(self.counts)
        top = np.cumsum(self.counts)[filled] - 1
        out[0, filled] = single[order[top]]
        out[1, filled] = single[order[np.where(self.counts[filled] > 1, top - 1, top)]]
        # a join matters only if it beats the second word of its text
        found = [(order[top], order[top], out[0, filled])]
        for first, last in self.joins(longest):
            margin = self.margins(first, last)
            high = margin > np.maximum(out[1, self.owner[first]], floor)
            found.append((first[high], last[high], margin[high]))
        first, last, margin = map(np.concatenate, zip(*found))
        place = np.lexsort((-margin, self.owner[first]))
        first, last, margin = first[place], last[place], margin[place]
        owner = self.owner[first]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        best = np.repeat(heads, np.diff(heads, append=len(owner)))
        out[0, owner[heads]] = margin[heads]
        apart = (last < first[best]) | (first > last[best])
        np.maximum.at(out[1], owner[apart], margin[apart])
        return out


def text_margins(df: DataFrame, table: np.ndarray, bias: float, longest: int, floor: float) -> DataFrame:
    """Adds best and second, the two highest margins of each text, to (doc_id, text, ...); text is left out."""
    sent = df.sparkSession.sparkContext.broadcast((table.astype(np.float32), bias))  # of fixed size
    rest = [c for c in df.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base = sent.value
        for part in (s for b in batches for s in slices(b)):
            out = Spans([t or "" for t in part.column(1).to_pylist()], weights, base).two_highest(longest, floor)
            kept = [part.column(0), *part.columns[2:], pa.array(out[0]), pa.array(out[1])]
            yield pa.RecordBatch.from_arrays(kept, [*rest, "best", "second"])

    schema = T.StructType([df.schema[c] for c in rest]).add("best", "double").add("second", "double")
    return df.mapInArrow(run, schema)


def labelled_sentences(texts: DataFrame) -> DataFrame:
    """sentence, label: each different sentence once, so that copies of a text count once; of (doc_id, text, label).

    A sentence of toxic and clean texts alike is a clean one.
    """
    parts = F.explode(F.split(F.col("text"), r"[.!?\n\r]+"))
    return texts.select(parts.alias("sentence"), "label").groupBy("sentence").agg(F.min("label").alias("label"))


def word_counts(sentences: DataFrame) -> DataFrame:
    """word, toxic, clean: how many toxic and clean sentences have the word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[int]] = {}
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in {plain(w) for w in words_of(text or "")}:
                    held.setdefault(word, [0, 0])[label] += 1
            held.pop("", None)
            words = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())] + [pa.array([held[w][k] for w in words], pa.int64()) for k in (1, 0)],
                ["word", "toxic", "clean"],
            )

    counts = sentences.mapInArrow(run, "word string, toxic bigint, clean bigint")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def disguised(word: str) -> list[str]:
    """The word with a sign and a letter inserted, and with gaps of one and two characters between all its characters."""
    half = len(word) // 2
    if len(word) < 4:
        return []
    return [f"{word[:half]}-{word[half:]}", f"{word[:half]}x{word[half:]}", ".".join(word), "..".join(word), "xz".join(word)]


def fit_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Logistic regression of the label on the columns of `margin`, both kinds smoothed as if two more texts were seen."""
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack((margin, np.ones(len(margin))))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - target) + 1e-6 * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return tuple(map(float, w))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from `docs` (doc_id, text) and `labels` (doc_id, label 0 or 1); None if a kind is missing."""
    chosen = labels.filter("label IN (0, 1) AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TEXTS)
    texts = stored(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label"), "labelled_texts")
    sizes = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    sentences = stored(labelled_sentences(texts), "sentences")
    counts = stored(word_counts(sentences), "word_counts")
    about = sentences.agg(F.avg("label").alias("share")).first()
    share = min(max(about.share or 0.0, 1e-6), 0.5)
    # so many toxic sentences with a word, and hardly a clean one, are chance for less than a word in the table
    least = max(2, math.ceil((math.log(max(2, counts.count())) + 1) / -math.log(share)))
    marked = counts.filter((F.col("toxic") > 0) & (F.col("clean") * CLEAN_SHARE <= F.col("toxic")))
    best = marked.agg(F.max("toxic").alias("most")).first().most
    # in few labelled texts no word may be that sure: those of most evidence speak then
    found = (
        marked.filter(F.col("toxic") >= min(least, best or least))
        .orderBy(F.desc("toxic"), "word").limit(MAX_WORDS).collect()
    )
    toxic, weight = [r.word for r in found], [float(r.toxic) ** 0.5 for r in found]
    usual = counts.filter("clean > 0 AND clean * 4 >= toxic")
    clean = [r.word for r in usual.orderBy(F.desc("clean"), "word").limit(MAX_WORDS // 4).collect()]
    clean += [r.word for r in usual.orderBy(F.xxhash64("word"), "word").limit(MAX_WORDS).collect()]
    if not toxic or not clean:
        return None
    longest = max(map(len, toxic))
    for word, heavy in list(zip(toxic, weight)):
        other = disguised(word)
        toxic += other
        weight += [0.2 * heavy] * len(other)
    table, bias = train_machine(toxic, clean, weight)
    clean += hardest(usual, table, bias)
    clean += hardest_joins(sentences.filter("label = 0"), table, bias, longest, set(toxic))
    table, bias = train_machine(toxic, clean, weight)
    floor = join_floor(texts.filter("label = 0").select("text"), table, bias, longest)
    seen = text_margins(texts.select("doc_id", "text"), table, bias, longest, floor).join(texts.select("doc_id", "label"), "doc_id")
    rows = seen.select("best", "second", "label").toPandas().to_numpy(float)  # MAX_TEXTS rows of numbers
    return Model(table, bias, longest, floor, fit_curve(rows[:, :2], rows[:, 2]))


def hardest(usual: DataFrame, table: np.ndarray, bias: float) -> list[str]:
    """The clean words with the highest margins."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(margins(words, table, bias))], ["word", "margin"])

    scored = usual.select("word").mapInArrow(run, "word string, margin double")
    return [r.word for r in scored.orderBy(F.desc("margin"), "word").limit(MAX_WORDS).collect()]


def hardest_joins(sentences: DataFrame, table: np.ndarray, bias: float, longest: int, toxic: set[str]) -> list[str]:
    """The joins of clean sentences with the highest margins, without the toxic words themselves."""
    sent = sentences.sparkSession.sparkContext.broadcast((table.astype(np.float32), bias))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base = sent.value
        for batch in (s for b in batches for s in slices(b, 0)):
            spans = Spans([t or "" for t in batch.column(0).to_pylist()], weights, base)
            best: dict[str, float] = {}
            for first, last in spans.joins(longest):
                margin = spans.margins(first, last)
                for i in np.argsort(-margin)[:MAX_WORDS].tolist():
                    best[spans.join(first[i], last[i])] = float(margin[i])
            words = [w for w in best if w not in toxic]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([best[w] for w in words], pa.float64())], ["word", "margin"]
            )

    scored = sentences.select("sentence").mapInArrow(run, "word string, margin double")
    scored = scored.groupBy("word").agg(F.max("margin").alias("margin"))
    return [r.word for r in scored.orderBy(F.desc("margin"), "word").limit(MAX_WORDS).collect()]


def join_floor(clean: DataFrame, table: np.ndarray, bias: float, longest: int) -> float:
    """The margin that all joins of `CLEAN_JOINS` of the clean texts stay below."""
    sent = clean.sparkSession.sparkContext.broadcast((table.astype(np.float32), bias))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, base = sent.value
        for batch in (s for b in batches for s in slices(b, 0)):
            found = Spans([t or "" for t in batch.column(0).to_pylist()], weights, base).highest_join(longest)
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["margin"])

    return clean.mapInArrow(run, "margin double").agg(F.percentile("margin", F.lit(CLEAN_JOINS))).first()[0]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def score(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    carry: bool = False,
) -> DataFrame:
    """doc_id, score, best, second of every row of `df`, after training on `labels` of rows that are not held out.

    With `carry`, the whole row comes along in the column `row`, so that nothing has to be joined back.
    """
    whole = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    docs = id_and_text(df, id_col, text_col)
    sent = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), whole)
    sent = sent if carry else docs
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    model = train(docs, known.filter(~F.coalesce(held_out(), F.lit(True))))
    if model is None:
        lowest = F.lit(LOWEST)
        return sent.drop("text").withColumns({"score": F.lit(0.0), "best": lowest, "second": lowest})
    a, b, c = model.curve
    curve = 1 / (1 + F.exp(-(F.col("best") * a + F.col("second") * b + c)))
    return text_margins(sent, model.table, model.bias, model.longest, model.floor).withColumn("score", curve)
