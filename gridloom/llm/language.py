"""Language identification by cross-parsing: the language whose text explains a document in the fewest phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import crc_of_id, slices, text_bytes

BLOCK = 1024  # characters read by one lane at a time; phrases run across its end
UNKNOWN = "und"
BUCKETS = 1024  # the sample takes one document of each hash bucket of a language; more where more are asked for


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


class Alphabet:
    """Codes for characters: 0 for everything that is no letter, 1.. for known letters, the last for other letters."""

    def __init__(self, letters: str):
        self.letters = letters
        self.size = len(letters) + 2
        self.table = np.fromiter(((self.size - 1) * chr(i).isalpha() for i in range(0x110000)), np.int32, 0x110000)
        self.table[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1, dtype=np.int32)

    def codes(self, text: str) -> np.ndarray:
        """Codes of a text, runs of non-letters as one blank, none at the ends."""
        out = self.table[code_points(text)]
        keep = out != 0
        keep[1:] |= out[:-1] != 0
        out = out[keep]
        if len(out) and out[0] == 0:
            out = out[1:]
        return out[:-1] if len(out) and out[-1] == 0 else out


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """The moves of each state of the automaton that reads exactly the factors of codes."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new, at = len(step), last
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                link[to] = link[new] = copy
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
        last = new
    return step


class Moves:
    """(state, code) -> state for sparse automata: rows of one array, laid over each other so that no two moves share a place.

    A state's moves stand at its base plus their codes, marked with the state that owns them. States
    with several moves are laid first, at the first base from a moving start that fits; those with
    one take the places that are left. So the size follows the moves that exist, whatever the alphabet.
    """

    def __init__(self, step: list[dict[int, int]], size: int, tries: int = 1):
        several = sorted((s for s, m in enumerate(step) if len(m) > 1), key=lambda s: -len(step[s]))
        total = sum(map(len, step))
        room = 2 * total + 4 * size
        used, self.base = np.zeros(room, bool), np.zeros(len(step), np.int64)
        owner, to = np.full(room, -1, np.int32), np.full(room, -1, np.int32)
        start = size
        for s in several:
            codes = np.fromiter(step[s], np.int64, len(step[s]))
            at = start
            while used[at + codes].any():
                at += 1
                if at - start > tries:
                    start = at = at + 1
                if at + size >= len(used):
                    used, owner, to = (np.concatenate([x, np.full(len(x), fill, x.dtype)]) for x, fill in ((used, False), (owner, -1), (to, -1)))
            used[at + codes] = True
            self.base[s] = at
            owner[at + codes], to[at + codes] = s, np.fromiter(step[s].values(), np.int64, len(codes))
        single = np.array([(s, *next(iter(m.items()))) for s, m in enumerate(step) if len(m) == 1], np.int64).reshape(-1, 3)
        free = np.flatnonzero(~used[size:]) + size
        if len(free) < len(single):
            grown = len(used) + len(single)
            free = np.concatenate([free, np.arange(len(used), grown)])
            owner, to = (np.concatenate([x, np.full(len(single), -1, np.int32)]) for x in (owner, to))
        free = free[: len(single)]
        self.base[single[:, 0]] = free - single[:, 1]
        owner[free], to[free] = single[:, 0], single[:, 2]
        last = int(np.flatnonzero(owner >= 0).max(initial=0)) + size + 1
        self.owner, self.to = (np.concatenate([x, np.full(size + 1, -1, np.int32)])[: last + 1] for x in (owner, to))
        self.base = np.minimum(self.base, last - size).astype(np.int32)

    def __call__(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Where the moves lead, -1 where there is none."""
        at = self.base.take(state) + code
        out = self.to.take(at)
        out[self.owner.take(at) != state] = -1
        return out


@dataclass
class CrossParser:
    """One automaton per language in one table of moves, and each language's own phrase rate."""

    languages: list[str]
    letters: str
    moves: Moves
    roots: np.ndarray
    rates: np.ndarray

    def __post_init__(self) -> None:
        self.alphabet = Alphabet(self.letters)
        size, k = self.alphabet.size, len(self.roots)
        self.restart = self.moves(np.repeat(self.roots, size), np.tile(np.arange(size), k)).reshape(k, size)

    def _walk(self, state: np.ndarray, lang: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and whether a phrase ended before c."""
        to = self.moves(state, c)
        ended = to < 0
        to[ended] = self.restart[lang[ended], c[ended]]
        return to, ended

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts x languages) counts of longest-match phrases of whole texts.

        Texts are cut into blocks that are read in step, each as if a phrase began with it. A block
        behind another is then read again from the state in which that one ends, until both readings
        begin a phrase at the same place, from where they agree; what this changes in the state at
        a block's end is passed on to the next block. So the counts are those of an unbroken parse.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        blocks = -(-sizes // BLOCK)
        n, k = int(blocks.sum()), len(self.languages)
        out = np.zeros((len(texts), k))
        if not n:
            return out
        owner = np.repeat(np.arange(len(texts)), blocks)
        within = np.arange(n) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        lengths = np.minimum(BLOCK, sizes[owner] - within * BLOCK)
        order = np.argsort(-lengths, kind="stable")
        lanes = np.zeros((n, BLOCK), np.int32)
        lanes[np.arange(BLOCK) < lengths[:, None]] = np.concatenate(texts)
        lanes = np.ascontiguousarray(lanes[order].T)
        owner, within, lengths = owner[order], within[order], lengths[order]
        active = np.searchsorted(-lengths, -np.arange(1, BLOCK + 1), side="right")
        state = np.repeat(self.roots.astype(np.int32)[:, None], n, axis=1)
        begins = np.zeros((BLOCK, k, n), bool)
        language = np.arange(k)[:, None]
        for i in range(int(lengths[0])):
            m = int(active[i])
            to, ended = self._walk(state[:, :m].ravel(), np.broadcast_to(language, (k, m)).ravel(), np.broadcast_to(lanes[i, :m], (k, m)).ravel())
            state[:, :m], begins[i, :, :m] = to.reshape(k, m), ended.reshape(k, m)
        begins[0] = True
        counts = begins.sum(axis=0, dtype=np.int32)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)  # where a block stands in the lanes
        behind = np.full(n, -1)
        more = np.flatnonzero(within[place] + 1 < blocks[owner[place]])
        behind[place[more]] = place[more + 1]  # the lane of the next block
        first = within == 0
        lang, lane = (x.ravel() for x in np.meshgrid(np.arange(k), np.flatnonzero(~first), indexing="ij"))
        before = np.full(n, -1)
        before[behind[behind >= 0]] = np.flatnonzero(behind >= 0)
        while len(lane):
            lang, lane = self._join(lang, lane, before, behind, lengths, lanes, state, begins, counts)
        for i in range(k):
            out[:, i] = np.bincount(owner, weights=counts[i], minlength=len(texts))
        return out

    def _join(self, lang, lane, before, behind, lengths, lanes, state, begins, counts) -> tuple[np.ndarray, np.ndarray]:
        """Read blocks again from their predecessors' last states; returns the blocks whose predecessor's state has changed by it."""
        at, own, open_ = state[lang, before[lane]], np.zeros(len(lane), np.int32), np.arange(len(lane))
        moved = np.zeros(len(lane), bool)
        for i in range(BLOCK):
            done = lengths[lane[open_]] <= i  # read to its end without agreeing
            if done.any():
                over = open_[done]
                moved[over] = state[lang[over], lane[over]] != at[over]
                state[lang[over], lane[over]] = at[over]
                counts[lang[over], lane[over]] = own[over]
                open_ = open_[~done]
            if not len(open_):
                break
            g, b = lang[open_], lane[open_]
            at[open_], ended = self._walk(at[open_], g, lanes[i, b])
            old = begins[i, g, b]
            begins[i, g, b] = ended
            own[open_] += ended
            agree = ended & old
            both = open_[agree]
            counts[lang[both], lane[both]] = own[both] + begins[i + 1 :, lang[both], lane[both]].sum(axis=0, dtype=np.int32)
            open_ = open_[~agree]
        else:
            moved[open_] = state[lang[open_], lane[open_]] != at[open_]
            state[lang[open_], lane[open_]] = at[open_]
            counts[lang[open_], lane[open_]] = own[open_]
        next_ = behind[lane]
        again = moved & (next_ >= 0)
        return lang[again], next_[again]

    def predict(self, bodies: list[str]) -> tuple[list[str], list[float]]:
        codes = [self.alphabet.codes(b) for b in bodies]
        sizes = np.array([len(c) for c in codes])
        norm = self.phrases(codes) / np.maximum(1, sizes)[:, None] / self.rates
        best = norm.argmin(axis=1)
        ranked = np.sort(norm, axis=1)
        second = ranked[:, min(1, len(self.languages) - 1)]
        score = np.where(len(self.languages) > 1, second / (ranked[:, 0] + second + 1e-12), 1.0)
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, sizes)], [float(x) if s else 0.0 for x, s in zip(score, sizes)]


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, characters: int) -> dict[str, list[str]]:
    """Language -> up to per_language pieces of labelled texts, each of at most `characters`; the fit's only sample."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null and length(body) > 0")
    h = F.xxhash64(F.lit(7), "id")
    best = known.select("id", "lang", h.alias("h")).groupBy("lang", F.pmod("h", F.lit(max(BUCKETS, 4 * per_language))).alias("bucket")).agg(F.min(F.struct("h", "id")).alias("best"))
    ranked = best.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("best")))  # as many rows of a language as it has buckets, at most
    chosen = ranked.filter(F.col("place") <= per_language).select("lang", "place", "best.*")
    start = F.pmod("h", F.greatest(F.lit(1), F.length("body") - characters)) + 1
    pieces = known.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "place").agg(F.min(F.substring("body", start.cast("int"), F.lit(characters))).alias("piece"))  # one row of an id
    out: dict[str, list[str]] = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.lang, r.place)):
        out.setdefault(r.lang, []).append(r.piece)
    return out


def fit_language_parser(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, characters: int = 240, most_characters: int = 400_000) -> CrossParser | None:
    """Learn from the labelled rows of docs; None when there is none.

    The sample is bounded: per_language pieces of at most `characters` for each language, and no
    more than most_characters in all automata together. Every letter of the sample has a code of its
    own, all others share one. Three quarters of a language's pieces make
    its automaton, the rest give its own phrase rate, by which counts are normalised.
    """
    sample = _sample(docs, id_col, text_col, lang_col, per_language, characters)
    languages = sorted(sample)
    if not languages:
        return None
    share = most_characters // len(languages)
    build = {k: " ".join(p for i, p in enumerate(sample[k]) if i % 4 != 3 or len(sample[k]) < 4)[:share] for k in languages}
    letters = "".join(sorted(c for c in set("".join(build.values()).lower()) if c.isalpha()))
    alphabet, steps, roots = Alphabet(letters), [], []
    for k in languages:
        roots.append(len(steps))
        first = len(steps)  # every code is a phrase at least
        steps += [{c: to + first for c, to in m.items()} for m in suffix_automaton([*alphabet.codes(build[k]).tolist(), *range(alphabet.size)])]
    parser = CrossParser(languages, letters, Moves(steps, alphabet.size), np.array(roots, np.int64), np.ones(len(languages)))
    for i, k in enumerate(languages):
        held = [alphabet.codes(p) for j, p in enumerate(sample[k]) if j % 4 == 3 or len(sample[k]) < 4]
        size = sum(map(len, held))
        if size:
            parser.rates[i] = parser.phrases(held)[:, i].sum() / size
    return parser


def predict_languages(docs: DataFrame, parser: CrossParser | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row, whole texts read.

    lang_pred is `und` with score 0 for null texts, texts without a letter, or when nothing was
    learned. score is the runner-up's share of the two smallest normalised phrase counts (0.5: a
    tie, which goes to the first language by name). One narrow pass; the model has a bounded size.
    """
    spark: SparkSession = docs.sparkSession
    model = spark.sparkContext.broadcast(parser and (parser.languages, parser.letters, parser.moves, parser.roots, parser.rates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CrossParser(*model.value) if model.value else None
        for batch in batches:
            for part in slices(batch, 1, 3 << 20):
                bodies = [b.decode("utf-8", "replace") for b in part.column(1).to_pylist()]
                names, scores = own.predict(bodies) if own else ([UNKNOWN] * len(bodies), [0.0] * len(bodies))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learn from labelled rows outside one fold of ids, predict all rows.

    Neither the label nor any other column is an input of a prediction. Repeated rows are predicted
    as often as they occur; an empty table gives no rows.
    """
    out = crc_of_id(F.col(id_col)) % folds == held
    parser = fit_language_parser(docs.filter(~out), id_col, text_col, lang_col)
    return predict_languages(docs, parser, id_col, text_col).withColumn("held_out", crc_of_id(F.col("doc_id")) % folds == held).select("doc_id", "held_out", "lang_pred", "score")
