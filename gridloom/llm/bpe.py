"""BPE encoding and decoding with a word-end vocabulary, word by word, on contiguous rank arrays."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_batch, slices, text_bytes
from .packing import byte_alphabet

WHITE = "\t-\r \x85\xa0  -     　"
NEVER = 1 << 40  # rank of a pair that does not merge
CACHED = 250_000  # entries of each cache; a full one starts again
CACHED_CHARACTERS = 40_000_000  # of all entries of a cache together


def merge_short(parts: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge a short word: keep the rank of every adjacent pair in one array, find the smallest
    (leftmost on ties), delete that boundary and refresh the two neighbouring ranks, until none merges."""
    none = (NEVER, -1)
    get = ranks.get
    near = list(map(get, zip(parts, parts[1:]), repeat(none)))
    while near:
        best = min(near)
        if best is none:
            break
        at = near.index(best)
        parts[at] = best[1]
        del parts[at + 1], near[at]
        if at:
            near[at - 1] = get((parts[at - 1], parts[at]), none)
        if at < len(near):
            near[at] = get((parts[at], parts[at + 1]), none)
    return parts


def merge_long(parts: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same merges for a long word, with a heap of pairs over a linked list."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r[0], i, r[1], parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, new, a, b = heapq.heappop(heap)
        j = after[i]
        if parts[i] != a or j >= n or parts[j] != b:
            continue
        parts[i], parts[j] = new, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (r := ranks.get((parts[x], parts[y]))):
                heapq.heappush(heap, (r[0], x, r[1], parts[x], parts[y]))
    return [p for p in parts if p >= 0]


class WordBpe:
    """Encoder and decoder of a vocabulary file whose words end in a suffix.

    The text is composed (NFC), lower-cased letter by letter and split at white space; matches of
    the file's split pattern never span white space, so what stands between two blanks is encoded
    once and kept in a bounded cache. Added tokens spelled in a text are found before all that.
    """

    SHORT = 256

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or not model["end_of_word_suffix"]:
            raise ValueError("not a vocabulary with NFC, white space, lower case and a word-end suffix")
        self.suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.ranks = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        letters = {byte: c for c, byte in byte_alphabet().items()}
        self.inner = [vocab.get(letters[b]) for b in range(256)]
        self.last = [vocab.get(letters[b] + self.suffix) for b in range(256)]
        self.words = regex.compile(split).findall
        self.blank = re.compile(f"[{WHITE}]+")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find_added = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self.ids_of: dict[str, str] = {}  # of what stands between blanks
        self.decoded_of: dict[str, str] = {}
        self.word_of: dict[str, tuple[str, str]] = {}  # of single words and runs of punctuation
        self.chunk_size = self.word_size = 0  # characters held by the caches

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        parts = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        parts = [p for p in parts if p is not None]  # a symbol that the vocabulary lacks is dropped
        return (merge_short if len(parts) <= self.SHORT else merge_long)(parts, self.ranks)

    def _word(self, word: str) -> tuple[str, str]:
        ids = self.encode_word(word)
        out = self.word_of[word] = " ".join(map(str, ids)), " ".join(map(self.tokens.__getitem__, ids))
        self.word_size += len(word) + len(out[0]) + len(out[1])
        return out

    def _learn(self, chunks: list[str]) -> None:
        if len(self.ids_of) > CACHED or self.chunk_size > CACHED_CHARACTERS:
            self.ids_of.clear()
            self.decoded_of.clear()
            self.chunk_size = 0
        if len(self.word_of) > CACHED or self.word_size > CACHED_CHARACTERS:
            self.word_of.clear()
            self.word_size = 0
        known = self.word_of.get
        for chunk in set(chunks).difference(self.ids_of):
            parts = [known(w) or self._word(w) for w in self.words(chunk)]
            if len(parts) == 1:
                self.ids_of[chunk], self.decoded_of[chunk] = parts[0]
            else:
                self.ids_of[chunk] = " ".join(filter(None, (p[0] for p in parts)))
                self.decoded_of[chunk] = " ".join(filter(None, (p[1] for p in parts)))
            self.chunk_size += len(chunk) + len(self.ids_of[chunk]) + len(self.decoded_of[chunk])

    def _spans(self, text: str) -> Iterator[tuple[str, int | None]]:
        at = 0
        for m in self.find_added.finditer(text) if self.find_added else ():
            yield text[at : m.start()], self.added[m[0]]
            at = m.end()
        yield text[at:], None

    def encode_and_decode(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by one space, and the decoded text of those ids."""
        ids: list[str] = []
        decoded: list[str] = []
        for span, special in self._spans(text):
            plain = unicodedata.normalize("NFC", span).replace("Σ", "σ").lower()
            chunks = [c for c in self.blank.split(plain) if c]
            self._learn(chunks)
            ids += map(self.ids_of.__getitem__, chunks)
            decoded += map(self.decoded_of.__getitem__, chunks)
            if special is not None:
                ids.append(str(special))
                decoded.append(self.tokens[special])
        return " ".join(filter(None, ids)), " ".join(filter(None, decoded))

    def encode(self, text: str) -> list[int]:
        ids = self.encode_and_decode(text)[0]
        return [int(i) for i in ids.split(" ")] if ids else []

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by one space, as a vocabulary file without a decoder is decoded."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@functools.cache
def coder(path: str) -> WordBpe:
    """One coder for each vocabulary file and Python worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, the ids themselves and the decoded text.

    A null text counts as empty and has no ids. One narrow pass: nothing is shuffled and a task's
    memory holds one slice of texts and a cache of bounded size. Repeated rows and null ids are
    kept, an empty table gives no rows, extra columns are not read.
    """
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    kinds += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoded, rows = coder(tokenizer_path), []
        for body in batch.column(1).to_pylist():
            ids, text = encoded.encode_and_decode(body.decode("utf-8", "replace"))
            row = (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
            rows.append((*row, [int(i) for i in ids.split(" ")] if ids else [], text) if with_ids else row)
        arrays = [batch.column(0), *(pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds[1:]))]
        return pa.RecordBatch.from_arrays(arrays, [k for k, _ in kinds])

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return by_batch(run)(part for batch in batches for part in slices(batch, 1))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body"))
    return rows.mapInArrow(sliced, schema)


def decode_documents(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text decoded from a column of ids; null ids count as none, unknown ids are left out."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        of = coder(tokenizer_path)
        texts = [of.decode(ids or []) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(by_batch(run), "doc_id long, text string")
