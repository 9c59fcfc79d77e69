"""Toxicity scores from a learned lexicon, matched by Levenshtein automata run against its trie."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, slices, text_bytes, unused

EDGES = ".,;:!?\"'()[]{}<>«»“”„‘’…*_~`|/\\-–—"
QUOTES = "\"“”„«»"
#: Words that report speech; fixed values.
REPORTING = frozenset("said says wrote quoted quote called reported sagte schrieb zitierte nannte dit écrit cité appelé dijo escribió citó llamó".split())
SPAN = 8  # tokens on each side of a hit that make its window
CACHED = 200_000


def edits_allowed(word: str) -> int:
    return 0 if len(word) < 5 else 1 if len(word) < 9 else 2


class FuzzyTrie:
    """Words and stems in a trie, intersected with the Levenshtein automata of all its words at once.

    A state is the set of (trie node, edits so far) that some automaton can be in; the deterministic
    table is filled as tokens ask for it, and begun anew when it holds most_positions positions. An
    edit is an inserted, dropped or changed character or a swap of neighbours. Stems match without
    edits, as the beginning of a token.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], most_positions: int = 500_000):
        self.child: list[dict[str, int]] = [{}]
        self.word: list[tuple[float, int] | None] = [None]
        self.stem: list[float | None] = [None]
        self.most = [0]
        for term, weight, fuzzy in [*((w, x, True) for w, x in words.items()), *((s, x, False) for s, x in stems.items())]:
            node, k = 0, edits_allowed(term) if fuzzy else 0
            self.most[0] = max(self.most[0], k)
            for c in term:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.word.append(None)
                    self.stem.append(None)
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            if fuzzy:
                self.word[node] = (weight, k)
            else:
                self.stem[node] = weight
        self.most_positions = most_positions
        self._begin()

    def _begin(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.stems_of: dict[int, float | None] = {}
        self.positions = 0
        self.start = self._state({(0, 0, "")})

    def _state(self, positions: set[tuple[int, int, str]]) -> int:
        """Number of the state after dropped characters; a third field is the letter a swap still owes."""
        todo = list(positions)
        while todo:
            node, edits, owed = todo.pop()
            if not owed:
                for to in self.child[node].values():
                    if edits < self.most[to] and (to, edits + 1, "") not in positions:
                        positions.add((to, edits + 1, ""))
                        todo.append((to, edits + 1, ""))
        key = frozenset(positions)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            self.positions += len(key)
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        to: set[tuple[int, int, str]] = set()
        for node, edits, owed in self.sets[state]:
            if owed:
                if c == owed:
                    to.add((node, edits, ""))
                continue
            if c in self.child[node]:
                to.add((self.child[node][c], edits, ""))
            if edits < self.most[node]:
                to.add((node, edits + 1, ""))
            for x, kid in self.child[node].items():
                if edits < self.most[kid]:
                    to.add((kid, edits + 1, ""))
                    if x != c and c in self.child[kid] and edits < self.most[self.child[kid][c]]:
                        to.add((self.child[kid][c], edits + 1, x))
        new = self._state(to) if to else -1
        self.moves[state][c] = new
        return new

    def match(self, token: str) -> tuple[float, int] | None:
        """(weight, edits) of the best term in the token: fewest edits, then the largest weight."""
        if self.positions > self.most_positions:
            self._begin()
        state, best, moves = self.start, None, self.moves
        for c in token:
            to = moves[state].get(c)
            state = self._move(state, c) if to is None else to
            if state < 0:
                return best
            if self._stem_of(state) is not None and (best is None or self._stem_of(state) > best[0]):
                best = (self._stem_of(state), 0)
        ends = [(edits, -self.word[node][0]) for node, edits, owed in self.sets[state] if not owed and self.word[node] and edits <= self.word[node][1]]
        if ends:
            edits, weight = min(ends)
            if best is None or edits == 0:
                best = (-weight, edits)
        return best

    def _stem_of(self, state: int) -> float | None:
        found = self.stems_of
        if state not in found:
            found[state] = max((self.stem[n] for n, e, owed in self.sets[state] if not e and not owed and self.stem[n] is not None), default=None)
        return found[state]


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Scorer:
    """Evidence of abuse in a text, and its probability under a fitted logistic model."""

    NAMES = ("total", "hits", "window", "quoted", "fuzzy", "density")

    def __init__(self, words: dict[str, float], stems: dict[str, float], benign: frozenset[str] = frozenset(), model: tuple | None = None):
        self.words, self.stems, self.benign, self.model = words, stems, benign, model
        self.trie = FuzzyTrie(words, stems)
        self.known: dict[str, tuple[float, int] | None] = {}

    def parts(self) -> tuple:
        return self.words, self.stems, self.benign, self.model

    def find(self, token: str) -> tuple[float, int] | None:
        plain = token.strip(EDGES)
        hit = self.trie.match(plain) if plain else None
        if hit is None and plain and not plain.isalnum():
            inner = [h for p in "".join(c if c.isalnum() else " " for c in plain).split() if (h := self.trie.match(p)) and not h[1]]
            hit = max(inner, default=None)
        return None if hit and hit[1] and plain in self.benign else hit

    def hits(self, tokens: list[str]) -> list[tuple[int, float, int]]:
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = self.find(t)
        flagged = {t for t in set(tokens) if known[t]}
        return [(i, *known[t]) for i, t in enumerate(tokens) if t in flagged] if flagged else []

    @staticmethod
    def is_quoted(tokens: list[str], at: int) -> bool:
        """Whether a hit stands between quotation marks or after a reporting word in its window."""
        before, behind = tokens[max(0, at - SPAN) : at], tokens[at + 1 : at + 1 + SPAN]
        opened = sum(t.count(q) for t in before for q in QUOTES) + sum(tokens[at][:1] == q for q in QUOTES)
        closed = sum(t.count(q) for t in behind for q in QUOTES) + sum(tokens[at].rstrip(".,;:!?")[-1:] == q for q in QUOTES)
        return bool(opened % 2 and closed) or any(t.strip(EDGES) in REPORTING for t in before[-3:])

    def features(self, text: str) -> list[float]:
        tokens = words_of(text)
        found = self.hits(tokens)
        if not found:
            return [0.0] * len(self.NAMES)
        weighed = []
        for at, weight, edits in found:
            quoted = self.is_quoted(tokens, at)
            weighed.append((at, weight * 0.5**edits, quoted, edits))
        own = [(at, w) for at, w, quoted, _ in weighed if not quoted]
        window, left, running = 0.0, 0, 0.0
        for at, w in own:
            running += w
            while own[left][0] < at - 2 * SPAN:
                running -= own[left][1]
                left += 1
            window = max(window, running)
        total = sum(w for _, w in own)
        return [
            math.log1p(total),
            min(len(own), 6) / 2,
            math.log1p(window),
            math.log1p(sum(w for _, w, quoted, _ in weighed if quoted)),
            math.log1p(sum(w for _, w, quoted, e in weighed if e and not quoted)),
            math.log1p(100 * total / max(20, len(tokens))),
        ]

    def score(self, features: list[list[float]]) -> np.ndarray:
        if not self.model:
            return np.zeros(len(features))
        weights, bias = self.model
        z = np.array(features).reshape(-1, len(self.NAMES)) @ weights + bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, steps: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6]) * len(x) / 100
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(beta)), design.T @ (y - p) - penalty @ beta)
        beta += step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta[:-1], float(beta[-1])


BROADCAST_LABELS = 1_000_000  # 16 bytes each; how labels are joined, not which


def _counted(rows: DataFrame, terms_of) -> DataFrame:
    """term, c (clean documents with it) and t (toxic ones, or their distinct contexts if those are fewer).

    terms_of gives a text's terms, each with the words around its first place. Copies of a toxic
    text repeat its contexts, so a term that only one text and its copies hold counts once. Each
    task counts its batches, Spark adds up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for body, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = terms_of(body.decode("utf-8", "replace"))
                if label:
                    toxic.update((t, xxhash.xxh3_64_intdigest(around) >> 1) for t, around in terms.items())
                else:
                    clean.update(terms.keys())
            columns = [[t for t, _ in toxic] + list(clean), [c for _, c in toxic] + [None] * len(clean), list(toxic.values()) + [0] * len(clean), [0] * len(toxic) + list(clean.values())]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(x, pa.int64()) for x in columns[1:])], ["term", "around", "t", "c"])

    counted = rows.mapInArrow(run, "term string, around long, t long, c long").groupBy("term", "around").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    return counted.groupBy("term").agg(F.least(F.sum("t"), F.count("around")).alias("t"), F.sum("c").alias("c"))


def _terms(text: str) -> dict[str, str]:
    """A text's words and, marked by a star, their beginnings, each with the words around its first place."""
    tokens = words_of(text)
    terms: dict[str, str] = {}
    first: dict[str, int] = {}
    for i, t in enumerate(tokens):
        first.setdefault(t, i)
    for t, i in first.items():
        if 3 <= len(w := t.strip(EDGES)) <= 30:
            around = " ".join(tokens[max(0, i - 1) : i + 2])
            for term in (w, *(w[:n] + "*" for n in range(4, min(8, len(w))))):
                terms.setdefault(term, around)
    return terms


def choose_terms(counts: list[tuple[str, int, int, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems of a lexicon from (term, toxic documents, clean documents, weight).

    A stem stands only where it covers clearly more than its best word; of nested stems with nearly
    the same documents the longest stands, otherwise the shortest. Words under a stem stay, so that
    they may be misspelled.
    """
    word = {t: (n, w) for t, n, _, w in counts if not t.endswith("*")}
    stem = {t[:-1]: (n, w) for t, n, _, w in counts if t.endswith("*")}
    best_word: dict[str, int] = defaultdict(int)
    longer: dict[str, int] = defaultdict(int)
    for w, (n, _) in word.items():
        for i in range(4, min(8, len(w) + 1)):
            best_word[w[:i]] = max(best_word[w[:i]], n)
    for s, (n, _) in stem.items():
        longer[s[:-1]] = max(longer[s[:-1]], n)
    stems: dict[str, float] = {}
    for s in sorted(stem, key=len):
        n, weight = stem[s]
        if n > 1.3 * best_word[s] and longer[s] < 0.97 * n and not any(s[:i] in stems for i in range(4, len(s))):
            stems[s] = weight
    return {w: x for w, (_, x) in word.items()}, stems


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = 20_000, most_terms: int = 4_000, least_evidence: float = 9.0, least_docs: int = 4, least_odds: float = 15.0) -> Scorer:
    """Learn a lexicon and a logistic model from labelled rows.

    The lexicon is counted over all labelled rows; the logistic model is fitted on at most most_rows
    of them (one of each hash bucket of ids, one row of docs for an id). Labels that name an id more
    than once count as their smallest. Terms are words of 3 to 30 characters and beginnings of 4 to 7.
    At most most_terms terms are kept: those with the largest log-likelihood ratio, of at least least_evidence, in least_docs toxic
    documents with different words around and with odds of least_odds or more. Tokens of clean documents that are only near a term are kept as
    benign. Without labels nothing is known and every score is zero.
    """
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("body"))
    few = named.count() <= BROADCAST_LABELS  # or else the texts are shuffled, twice
    rows = texts.join(F.broadcast(named) if few else named, "id").select("body", "y")
    h = F.xxhash64(F.lit(3), "id")
    one = named.groupBy(F.pmod(h, F.lit(most_rows)).alias("bucket")).agg(F.min(F.struct(h.alias("h"), "id", "y")).alias("r"))
    chosen = F.broadcast(one.select("r.id", "r.y"))  # at most most_rows rows
    sample = texts.join(chosen, "id").groupBy("id").agg(F.min("body").alias("body"), F.first("y").alias("y")).select("body", "y")
    share = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    toxic, clean = share.t, share.n - share.t
    if not toxic or not clean:
        return Scorer({}, {})
    rate = toxic / share.n
    t, c = F.col("t"), F.col("c")
    evidence = t * F.log(t / ((t + c) * rate)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0)
    odds = ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1))
    terms = _counted(rows, _terms).filter(t >= least_docs).withColumn("evidence", evidence).withColumn("odds", odds)
    kept = terms.filter((F.col("evidence") >= least_evidence) & (F.col("odds") >= least_odds)).orderBy(F.desc("evidence"), "term").limit(most_terms).collect()
    words, stems = choose_terms([(r.term, r.t, r.c, math.log(r.odds)) for r in kept])
    first = Scorer(words, stems)

    def near(text: str) -> dict[str, str]:
        return {t.strip(EDGES): "" for t in set(words_of(text)) if (h := first.find(t)) and h[1]}

    benign = _counted(rows, near).filter(c >= 2 * t + 1).orderBy(F.desc("c"), "term").limit(most_terms).collect()
    second = Scorer(words, stems, frozenset(r.term for r in benign))
    found = _features(sample, second).toArrow()  # at most most_rows rows of a few numbers
    model = fit_logistic(np.array(found.column("x").to_pylist(), float).reshape(-1, len(Scorer.NAMES)), found.column("y").to_numpy().astype(float))
    return Scorer(words, stems, second.benign, model)


def _features(rows: DataFrame, scorer: Scorer) -> DataFrame:
    parts = scorer.parts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*parts)
        for batch in batches:
            x = [own.features(b.decode("utf-8", "replace")) for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    return rows.mapInArrow(run, "x array<double>, y int")


def scoring(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> Column:
    """The score of a whole text, 0 to 1. Null and empty texts have no hits and get the model's lowest evidence."""
    model = docs.sparkSession.sparkContext.broadcast(scorer.parts())

    @F.arrow_udf("double")
    def score(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Scorer(*model.value)
        for batch in bodies:
            yield pa.array(own.score([own.features(b.decode("utf-8", "replace")) for b in batch.to_pylist()]), pa.float64())

    return score(text_bytes(F.col(text_col)))


def score_toxicity(docs: DataFrame, scorer: Scorer, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs with _score (0 to 1) and _predicted (1 from the threshold on); whole texts are read.

    Columns of docs named _score or _predicted are replaced. Nothing is shuffled; the scorer has a bounded size.
    """
    scored = docs.withColumn("_score", scoring(docs, scorer, text_col))
    return scored.withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))


def learned_scorer(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """A scorer learned outside one fold of ids."""
    return fit_toxicity(docs, labels.filter(crc_of_id(F.col(id_col)) % folds != held), id_col, text_col)


def keep_benign(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns and no others."""
    own = unused(docs, "score")
    scored = docs.withColumn(own, scoring(docs, learned_scorer(docs, labels, folds, held, id_col, text_col), text_col))
    return scored.filter(F.col(own) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def classify_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs with _held_out, _score, _predicted: learn outside one fold of ids, score all rows.

    Repeated rows are scored as often as they occur; an empty table gives no rows. Columns of docs
    with the three names are replaced.
    """
    scorer = learned_scorer(docs, labels, folds, held, id_col, text_col)
    return score_toxicity(docs, scorer, threshold, id_col, text_col).withColumn("_held_out", crc_of_id(F.col(id_col)) % folds == held)
