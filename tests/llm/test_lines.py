"""Line labels and quality rules against plain versions."""

import itertools
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import lines
from gridloom.llm.queries import queries

SCHEMA = "doc_id long, text string"


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in repeated for j in range(5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


def texts(rng, n):
    pieces = ["a", "bb", "é", "日本", "#", "x|y", "$$", " wide ", "ab cd", "A"]
    for _ in range(n):
        yield "".join(rng.choice(pieces) + rng.choice([" ", " ", "\n", "\n\n", "\t", "\r\n", "\x0b", ""]) for _ in range(rng.randrange(40)))


def test_counts_equal_the_plain_version(spark):
    rng = random.Random(3)
    cases = [None, "", " \n\t", "#", "one", "a b c d e", "a b c d e f", "a " * 11, "a b c d e a b c d e", "x\nx\nx", "x\n x\nx ", *texts(rng, 150)]
    rows = spark.createDataFrame(list(enumerate(cases)) + [(None, "a b"), (4, "one")], SCHEMA).withColumns({c: F.lit(9) for c in ("kept", "n_words", "body", "good")})
    got = lines.line_quality(rows, None).collect()
    assert len(got) == len(cases) + 2 and sum(r.doc_id == 4 for r in got) == 2
    for r in got:
        text = cases[r.doc_id] if r.doc_id is not None else "a b"
        want = plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(text)
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r.kept == (not r.base_failed)
    assert lines.line_quality(rows.limit(0), None).count() == 0


def test_long_texts_are_counted_in_blocks(monkeypatch):
    rng = random.Random(8)
    many = list(texts(rng, 80))
    whole = [lines.describe(t.encode()) for t in many]
    monkeypatch.setattr(lines, "BLOCK", 7)
    for t, w in zip(many, whole):
        cut = lines.describe(t.encode())
        assert (cut.word_chars, cut.n_symbols) == (w.word_chars, w.n_symbols) and np.array_equal(cut.features, w.features)


def score(field, features, labels):
    e = features @ field.weights
    return sum(e[i] for i, y in enumerate(labels) if y) + sum(field.moves[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_finds_the_best_of_all_labelings():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        for _ in range(10):
            field, x = lines.Field(rng.standard_normal(3), rng.standard_normal((2, 2))), rng.standard_normal((n, 3))
            best = max(score(field, x, y) for y in itertools.product((0, 1), repeat=n))
            assert abs(score(field, x, field.labels(x).tolist()) - best) < 1e-9
    assert lines.Field(np.zeros(2), np.zeros((2, 2))).labels(np.zeros((4, 2))).tolist() == [1] * 4


def test_fit_finds_the_most_probable_weights():
    """No step away from the fitted weights gains: likelihoods by summing over all labelings."""
    rng = np.random.default_rng(2)
    chains = [(rng.standard_normal((n, 2)), rng.integers(0, 2, n)) for n in (1, 2, 3, 4, 5, 5, 4)]
    x, mask = lines._padded([c for c, _ in chains])
    y = np.zeros(mask.shape, np.int64)
    for i, (_, own) in enumerate(chains):
        y[i, : len(own)] = own
    field = lines.fit_chain(x, mask, y, steps=3000, rate=0.02, shrink=0.05)

    def value(theta):
        f = lines.Field(theta[:2], theta[2:].reshape(2, 2))
        whole = sum(score(f, c, own.tolist()) - np.log(sum(np.exp(score(f, c, z)) for z in itertools.product((0, 1), repeat=len(c)))) for c, own in chains)
        return whole / mask.sum() - 0.05 / 2 * theta @ theta

    theta = np.concatenate([field.weights, field.moves.ravel()])
    for i in range(6):
        for step in (-0.05, 0.05):
            assert value(theta + step * (np.arange(6) == i)) < value(theta)


def test_boilerplate_lines_are_told_apart_within_bad_documents():
    good = "The river runs past the old mill and turns north.\nNobody has counted the stones under the bridge.\n"
    junk = "home | about | login | terms | cart |\nBUY!! NOW!! CHEAP!! BEST!! DEAL!!\n"
    documents = [(1, lines.describe((good * (1 + i % 3)).encode()).features) for i in range(60)] + [(0, lines.describe((good * (i % 2) + junk * (1 + i % 4) + good * (i % 3)).encode()).features) for i in range(20)]
    field = lines.learn(documents)
    mixed = lines.describe((good + junk + "Grey herons nest in the reeds below the weir.\nThe ferryman keeps a list of all of them.\n").encode())
    assert field.labels(mixed.features).tolist() == [1, 1, 0, 0, 1, 1]
    assert abs(lines.content_share(field.labels(mixed.features), mixed.words) - 37 / 53) < 0.02
    assert lines.learn(documents[:60]) is None and lines.learn([]) is None


def test_contradictory_and_missing_marks(spark):
    docs = spark.createDataFrame([(1, "a b."), (2, "x | y |"), (3, None), (None, "n")], SCHEMA)
    marks = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    assert lines.train_field(docs, marks([])) is None
    assert lines.train_field(docs, marks([(1, 1), (1, 0), (2, 0), (None, 1), (3, 1), (9, 1)])) is None
    assert lines.train_field(docs, marks([(1, 1), (1, 1), (2, 0), (2, None)])) is not None


def test_held_out_documents(spark):
    """Fitted without every fifth document: good ones stay, bad ones go."""
    folder = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    field = lines.train_field(docs, marks.filter(~out))
    got = lines.line_quality(docs, field).join(marks.filter(out), "doc_id").select("doc_id", "quality", "kept", "base_failed").collect()
    assert len(got) > 60 and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    good, bad = ([r for r in got if r.quality == q] for q in (1, 0))
    assert sum(r.kept for r in good if not r.base_failed) >= 0.98 * sum(not r.base_failed for r in good)
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries()["op12_crf_line_quality"](spark, folder).collect()}
    table = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(table)
    for d in table:
        r = got[d.doc_id]
        if len(d.text or "") < 20_000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(d.text)
        assert not (r.base_failed and r.kept)
