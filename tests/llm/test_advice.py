
import random

import corpus_pipeline
import numpy as np
from gridloom.llm import ann, blocks, similar, topk, toxicity
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def words(rng, n, size=10**9):
    return [f"{rng.choice('bcdfgkl')}{rng.choice('aeiou')}{rng.randrange(size)}" for _ in range(n)]


# --- near-duplicates of the pipeline ---------------------------------------------------------------


def plain_groups(texts, width=5, least=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (len(a & b) / len(a | b) if a | b else 1) >= least:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def edited_corpus():
    rng = random.Random(21)
    line, texts = words(rng, 12), [None, "", " \t", "One", "one", "a b c d e", "A b c d e", "a b c d f", "x " * 50]
    for i in range(60):
        base = words(rng, rng.choice([20, 60, 200]))
        texts.append(" ".join(base + line))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for at in rng.sample(range(len(base)), rng.randrange(1, max(2, len(base) // 20))):
                copy[at] = "changed"
            texts.append(" ".join(copy + line))
    return texts + texts[20:30]


def test_pipeline_links_exactly_the_pairs_of_the_similarity(spark):
    texts = edited_corpus()
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, texts), None)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain_groups(texts)))


def test_components_in_small_cells_equal_all_pairs(spark):
    texts = edited_corpus()
    rows = similar.similar_components(docs(spark, texts), cell_rows=3).collect()
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(plain_groups(texts)))
    assert similar.similar_components(docs(spark, texts).limit(0)).count() == 0


def test_bitmaps_never_differ_in_more_bits_than_the_sets_do():
    rng = np.random.default_rng(3)
    for size in (0, 1, 50, 500, 5000):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for extra in (0, 1, 40, 400):
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, extra, dtype=np.uint64)])) for _ in range(2))
            differ = int(np.bitwise_count(similar.bitmap(a) ^ similar.bitmap(b)).sum())
            assert differ <= len(np.setxor1d(a, b)) and (differ > 0) == (extra > 0)
            wide = similar.bitmap(a, 64)
            assert (wide[:32] ^ wide[32:] == similar.bitmap(a, 32)).all() and similar.wide_words(len(a)) * 64 >= len(a)


# --- toxicity --------------------------------------------------------------------------------------


def test_every_word_may_be_misspelled_and_the_table_stays_bounded():
    rng = random.Random(22)
    lexicon = {"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(6, 12))): 5.0 for _ in range(600)}
    wide, small = toxicity.FuzzyTrie(lexicon, {}), toxicity.FuzzyTrie(lexicon, {}, most_positions=5000)
    for w in list(lexicon)[::7]:
        swapped = w[:2] + w[3] + w[2] + w[4:]
        assert wide.match(swapped) and wide.match(swapped) == small.match(swapped)
    assert small.positions < wide.positions


def test_words_under_a_stem_may_be_misspelled():
    counts = [("idiot", 10, 0, 4.0), ("idiots", 9, 0, 4.0), ("idiotic", 9, 0, 4.0), ("idio*", 28, 0, 4.5), ("idiot*", 28, 0, 4.5)]
    words_, stems = toxicity.choose_terms(counts)
    trie = toxicity.FuzzyTrie(words_, stems)
    assert stems and trie.match("idiotically")[1] == 0
    assert all(trie.match(t) for t in ("idoit", "id1ot", "idoits", "idi0tic"))


def test_lexicon_is_counted_over_all_labelled_rows(spark):
    rng = random.Random(23)
    plain = words(rng, 300)
    texts = [" ".join(rng.choices(plain, k=30) + (["vilescum", rng.choice(plain)] if i % 20 == 0 else [])) for i in range(400)]
    texts[20] += " rareslur x"
    for i in (60, 120, 200, 340):
        texts[i] += f" rareslur {plain[i % 300]}"
    table = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(400)], "doc_id long, toxic int")
    scorer = toxicity.fit_toxicity(table.union(table), labels, most_rows=60)
    assert scorer.words.keys() | {s + "*" for s in scorer.stems} >= {"vilescum", "rareslur"}


def test_fit_sees_one_row_of_an_id(spark):
    real, seen = toxicity.fit_logistic, []
    toxicity.fit_logistic = lambda x, y: seen.append(len(x)) or real(x, y)
    try:
        texts = ["good day all of you", "vilescum is what you are"] * 30
        table = docs(spark, texts)
        labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
        toxicity.fit_toxicity(table.union(table).union(table), labels, most_rows=40)
    finally:
        toxicity.fit_logistic = real
    assert seen and seen[0] <= 40


# --- nearest vectors -------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def found(result):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in result.collect())


def test_a_row_repeated_more_than_k_times_counts_once(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(1, 40)]
    copied = vectors(spark, rows + rows[-1:] * 30 + rows[-2:-1] * 30 + rows[:1] * 3)
    asked = F.col("vec_id") == 0
    for search, scale in ((topk.exact_top_k, 65536), (ann.nearest_in_partitions, 1)):
        assert found(search(copied, asked, k=5)) == [(0, n + 1, 39 - n, scale * (39 - n)) for n in range(5)]


def test_vectors_of_one_id_spread_over_blocks(spark):
    rows = [(7, [float(i), 1.0]) for i in range(400)] + [(0, [1.0, 1.0])]
    df = vectors(spark, rows)
    data = df.select("vec_id", F.col("embedding").alias("v"), F.lit(0).alias("part"))
    asked = df.filter("vec_id = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("v"), F.lit(0).alias("home"), F.array(F.lit(0)).alias("parts"), F.lit(None).cast("double").alias("least"))
    sizes = blocks.block_search(data, asked, lambda qid, q, least, did, d: (np.zeros(1, int), did[:1] * 0 + len(did), np.zeros(1)), 100, "double", 50).collect()
    assert len(sizes) > 4 and max(r.vec_id for r in sizes) < 150


def test_vectors_of_every_length_are_searched(spark):
    rows = [(i, [float(i), 1.0]) for i in range(40)] + [(100 + i, [1.0, float(i), 2.0]) for i in range(6)] + [(200, [1.0, 1.0, 1.0, 1.0])]
    asked = F.col("vec_id").isin(0, 100, 105, 200)
    got = found(ann.nearest_in_partitions(vectors(spark, rows), asked, k=2))
    assert got == [(0, 1, 1, 1), (0, 2, 2, 1), (100, 1, 101, 5), (100, 2, 102, 5), (105, 1, 104, 25), (105, 2, 103, 20)]
