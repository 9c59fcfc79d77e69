"""Document quality by labelling lines as content or boilerplate with a linear-chain conditional random field.

Every line with a word is described by a few shares and marks. Viterbi decoding labels the lines of a
document together; the words in content lines as a share of all words decide whether it is retained.
The field learns from documents marked good or bad: lines of good documents are content, and which
lines of bad ones are boilerplate is settled by turns of decoding and fitting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
BOILERPLATE, CONTENT = 0, 1
FEATURES = ["always", "few words", "many words", "long words", "capitals", "symbols", "other marks", "digits", "closed", "repeated line", "repeated words", "repeated windows", "address", "first", "last"]
FIT = "good int, lines int, features array<float>"


def _classes() -> np.ndarray:
    table = np.full(256, 7, np.int64)
    table[list(range(0x80, 0xC0))] = 0  # second and later bytes of a code point
    table[list(BLANKS)] = 1
    table[list(SYMBOLS)] = 2
    table[[b for b in range(33, 127) if not chr(b).isalnum() and b not in SYMBOLS and chr(b) not in ".,;:'\"?-()"]] = 3
    table[list(range(48, 58))] = 4
    table[list(range(65, 91))] = 5
    table[list(range(97, 123))] = 6
    return table


CLASS = _classes()
MIX = np.random.default_rng(5).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = 1 << 20  # bytes counted at once


def class_counts(body: bytes, lengths: np.ndarray) -> np.ndarray:
    """Bytes of each class in each line, its line feed included; lengths are those of the lines without it."""
    data = np.frombuffer(body, np.uint8)
    ends = np.cumsum(lengths + 1)
    counts = np.zeros(8 * len(lengths), np.int64)
    for at in range(0, len(data), BLOCK):
        block = CLASS[data[at : at + BLOCK]]
        first, last = np.searchsorted(ends, (at, at + len(block) - 1), side="right")
        sizes = np.minimum(ends[first : last + 1], at + len(block)) - np.maximum(ends[first : last + 1] - lengths[first : last + 1] - 1, at)
        counts[8 * first : 8 * (last + 1)] += np.bincount(np.repeat(np.arange(last + 1 - first) * 8, sizes) + block, minlength=8 * (last + 1 - first))
    return counts.reshape(-1, 8)


@dataclass
class Described:
    """A text's counts, and for each of its lines with a word the features and the number of words."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: np.ndarray
    words: np.ndarray


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def covered_by_repeats(ids: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Which words (word_numbers) stand in a window of `width` words that the text has twice or more."""
    n = len(ids)
    covered = np.zeros(n, bool)
    if n <= width:
        return covered
    mixed = sum(ids[i : n - width + 1 + i].astype(np.uint64) * m for i, m in enumerate(MIX[:width]))
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():  # equal windows have equal sums; where some are equal, exact names decide
        return covered
    name = ids
    for i in range(1, width):  # equal names: equal windows of i + 1 words
        pair = name[:-1] * np.int64(n) + ids[i:]
        name = np.unique(pair, return_inverse=True)[1] if i < width - 1 else pair
    _, at, times = np.unique(name, return_inverse=True, return_counts=True)
    step = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(times[at] > 1)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def describe(body: bytes) -> Described:
    words = body.split()  # bytes: the six ASCII blanks only
    if not words:
        symbols = sum(body.count(s) for s in (bytes([b]) for b in SYMBOLS))
        return Described(0, 0, symbols, 0, 0, np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64))
    lines = body.split(b"\n")
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    per_line = class_counts(body, lengths)
    total = per_line.sum(axis=0)
    per_words = np.fromiter((len(line.split()) for line in lines), np.int64, len(lines))
    kept = np.flatnonzero(per_words)

    seen: set[bytes] = set()
    again = np.zeros(len(lines), bool)
    for i in kept.tolist():
        again[i] = lines[i] in seen
        seen.add(lines[i])
    ids = word_numbers(words)
    repeats = covered_by_repeats(ids)
    last = np.cumsum(per_words)
    in_line = lambda flags: (t := np.concatenate([[0], np.cumsum(flags)]))[last] - t[last - per_words]
    follows = np.concatenate([[False], ids[1:] == ids[:-1]])

    n = per_words[kept].astype(np.float64)
    chars = np.maximum(1, per_line.sum(axis=1) - per_line[:, 0] - per_line[:, 1])[kept].astype(np.float64)
    letters = np.maximum(1, per_line[kept, 5] + per_line[kept, 6])
    tail = [lines[i].rstrip() for i in kept.tolist()]
    columns = [
        np.ones(len(kept)), n <= 3, np.minimum(1, n / 60), np.clip((chars / n - 9) / 9, 0, 1), per_line[kept, 5] / letters, np.minimum(1, 10 * per_line[kept, 2] / chars), np.minimum(1, 10 * per_line[kept, 3] / chars),
        per_line[kept, 4] / chars, np.fromiter((t.endswith((b".", b"?", b"!", b":", b"\xe2\x80\xa6")) and not t.endswith(b"!!") for t in tail), bool, len(kept)), again[kept], in_line(follows)[kept] / n, in_line(repeats)[kept] / n,
        np.fromiter((b"://" in t or b"www." in t or b"@" in t for t in tail), bool, len(kept)), np.arange(len(kept)) == 0, np.arange(len(kept)) == len(kept) - 1,
    ]
    return Described(len(words), len(body) - int(total[0]) - int(total[1]), int(total[2]), int(again.sum()), int(repeats.sum()), np.stack(columns, axis=1).astype(np.float32), per_words[kept])


@dataclass
class Field:
    """A chain of two labels: a weight of content for each feature, and a weight for each move from label to label."""

    weights: np.ndarray
    moves: np.ndarray

    def labels(self, features: np.ndarray) -> np.ndarray:
        """The most probable labels of a document's lines, by Viterbi; content where two are equally probable."""
        n = len(features)
        if not n:
            return np.zeros(0, np.int8)
        emission = (features @ self.weights).tolist()
        (bb, bc), (cb, cc) = self.moves.tolist()
        b, c, back = 0.0, emission[0], []
        for e in emission[1:]:
            to_b, to_c = cb + c >= bb + b, cc + c >= bc + b
            back.append((to_b, to_c))
            b, c = (cb + c if to_b else bb + b), (cc + c if to_c else bc + b) + e
        out = np.zeros(n, np.int8)
        at = CONTENT if c >= b else BOILERPLATE
        for i in range(n - 1, 0, -1):
            out[i] = at
            at = int(back[i - 1][at])
        out[0] = at
        return out


def content_share(labels: np.ndarray, words: np.ndarray) -> float:
    return float(words[labels == CONTENT].sum() / words.sum()) if words.sum() else 0.0


def _padded(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = max(map(len, pieces))
    out = np.zeros((len(pieces), size, pieces[0].shape[1]))
    mask = np.zeros((len(pieces), size), bool)
    for i, p in enumerate(pieces):
        out[i, : len(p)], mask[i, : len(p)] = p, True
    return out, mask


def fit_chain(x: np.ndarray, mask: np.ndarray, y: np.ndarray, start: Field | None = None, steps: int = 100, rate: float = 0.1, shrink: float = 1e-3) -> Field:
    """The field with the largest penalised likelihood of labels y of padded chains x, by Adam steps on exact gradients (forward and backward sums)."""
    chains, size, d = x.shape
    theta = np.concatenate([start.weights, start.moves.ravel()]) if start else np.zeros(d + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    real = mask.sum()
    pair = mask[:, 1:]
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    seen = np.concatenate([(x * (y * mask)[..., None]).sum(axis=(0, 1)), seen_moves.ravel()])
    for step in range(1, steps + 1):
        e = np.zeros((chains, size, 2))
        e[..., 1] = x @ theta[:d]
        moves = theta[d:].reshape(2, 2)
        ahead = np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, size):
            new = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + e[:, t]
            ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
        behind = np.zeros_like(e)
        for t in range(size - 2, -1, -1):
            after = e[:, t + 1] + behind[:, t + 1]
            new = np.stack([np.logaddexp(moves[i, 0] + after[:, 0], moves[i, 1] + after[:, 1]) for i in (0, 1)], axis=1)
            behind[:, t] = np.where(mask[:, t + 1, None], new, 0)
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        content = np.exp(ahead[..., 1] + behind[..., 1] - whole[:, None]) * mask
        expected = [(x * content[..., None]).sum(axis=(0, 1))]
        for i in (0, 1):
            for j in (0, 1):
                expected.append([(np.exp(ahead[:, :-1, i] + moves[i, j] + e[:, 1:, j] + behind[:, 1:, j] - whole[:, None]) * pair).sum()])
        gradient = (seen - np.concatenate(expected)) / real - shrink * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:d], theta[d:].reshape(2, 2))


def learn(documents: list[tuple[int, np.ndarray]], turns: int = 4, piece_lines: int = 32) -> Field | None:
    """The field of (good, features of the lines) of labelled documents; None unless both kinds are there.

    Lines of good documents are content. All lines of bad ones start as boilerplate; after each fit they
    are decoded anew, and those that read as content count as content in the next one, but for the
    line with the least content in a document that would keep none. Chains are cut into pieces of
    piece_lines lines.
    """
    documents = [(good, f) for good, f in documents if len(f)]
    if len({good for good, _ in documents}) < 2:
        return None
    labels = [np.full(len(f), CONTENT if good else BOILERPLATE) for good, f in documents]
    cuts = [(i, at) for i, (_, f) in enumerate(documents) for at in range(0, len(f), piece_lines)]
    x, mask = _padded([documents[i][1][at : at + piece_lines] for i, at in cuts])
    field = None
    for turn in range(turns):
        y = np.zeros(mask.shape, np.int64)
        for row, (i, at) in enumerate(cuts):
            own = labels[i][at : at + piece_lines]
            y[row, : len(own)] = own
        if turn:
            field = fit_chain(x, mask, y, field)
        else:  # lines on their own: in chains of one label only, the moves would settle everything
            field = fit_chain(x.reshape(-1, 1, x.shape[2]), mask.reshape(-1, 1), y.reshape(-1, 1))
        for i, (good, f) in enumerate(documents):
            if not good:
                labels[i] = field.labels(f).astype(np.int64)
                if labels[i].all():
                    labels[i][int(np.argmin(f @ field.weights))] = BOILERPLATE
    return field


def train_field(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rows: int = 2_000, most_lines: int = 40) -> Field | None:
    """The field learned from at most most_rows labelled documents, of each its first most_lines lines with a word; see learn."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good"), F.max("quality").alias("best")).filter("good = best").select("doc_id", "good")
    # a hash picks about most_rows documents; the limit then holds exactly
    every = F.pmod(F.xxhash64(F.lit(12), "doc_id"), F.lit(1 << 30)) * F.greatest(F.lit(1.0), F.lit(marks.count() / most_rows)) < F.lit(float(1 << 30))
    picked = F.broadcast(marks.filter(every).orderBy(F.xxhash64(F.lit(12), "doc_id"), "doc_id").limit(most_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body")).join(picked, "doc_id")
    texts = texts.groupBy("doc_id", "good").agg(F.min("body").alias("body")).select("good", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = [describe(b).features[:most_lines] for b in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int32()), pa.array([len(f) for f in found], pa.int32()), pa.array([f.ravel() for f in found], pa.list_(pa.float32()))], ["good", "lines", "features"])

    rows = texts.mapInArrow(run, FIT).toArrow()  # most_rows rows of most_lines lines at most
    return learn(sorted(((good, np.asarray(f, np.float32).reshape(n, len(FEATURES))) for good, n, f in zip(*(c.to_pylist() for c in rows.columns))), key=lambda d: (d[0], d[1].tobytes())))


def line_quality(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text", least_content: float = 0.5, least_words: int = 10, most_repeated_percent: int = 20) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, n_content_lines, kept.

    Words are runs without ASCII blanks of the whole text. base_failed: fewer than least_words words, or
    more than most_repeated_percent per cent of them in windows of five words that the text has twice or
    more. kept: not base_failed, and at least least_content of the words stand in lines that the field
    labels as content; without a field all lines are content.

    Null and empty texts have no words and fail. Texts are read whole, one slice of a few MB at a time.
    Repeated rows and null ids are returned as they are, an empty table gives no rows, extra
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, n_content_lines long, kept boolean"
    names = [c.split()[0] for c in schema.split(", ")]

    def verdict(body: bytes) -> tuple:
        d = describe(body)
        labels = shared.value.labels(d.features) if shared.value else np.ones(len(d.words), np.int8)
        share = content_share(labels, d.words)
        failed = d.n_words < least_words or 100 * d.n_repeat_words > most_repeated_percent * d.n_words
        return d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words, failed, share, int(labels.sum()), not failed and share >= least_content

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                columns = zip(*(verdict(b) for b in part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in columns)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body")).mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """line_quality with a field learned from the labels (doc_id, quality 0 or 1); null or contradictory marks are not used."""
    return line_quality(docs, train_field(docs, labels), **options)
