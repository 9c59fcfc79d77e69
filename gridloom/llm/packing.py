"""Hierarchical multi-length packing of token sequences.

Documents are routed to tiers of context sizes, every tier is packed on its own, gaps of long
windows are filled from shorter tiers, and full windows are dealt into step groups of equal size.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes

TIERS = (1024, 512, 256, 128)
STEP_TOKENS = 16_384


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.cache
def encoder(path: str):
    """text -> ids as a uint32 array, as the tokenizers library gives them without special tokens added.

    A byte-level vocabulary whose ids grow along its merges is run by its ranks; texts that spell an
    added token, and vocabularies of any other make, go through the tokenizers library.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    exact.no_truncation()
    exact.no_padding()
    slow = lambda text: np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = model.get("vocab")
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    if not plain or spec.get("normalizer") or spec.get("post_processor") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return slow
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:])):
        return slow
    import public_tokenizers
    import tiktoken

    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [t["content"] for t in spec.get("added_tokens", [])]
    return lambda text: slow(text) if any(a in text for a in added) else np.asarray(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)


class Packer:
    """Packs the documents of one task; rows come out as windows fill up.

    A document gives whole windows of the longest tier first; what remains goes to the shortest tier
    that holds it. Every tier has one open window, and a piece that does not fit is cut there, so
    only the open windows at the end have gaps.
    """

    def __init__(self, task: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = sorted(tiers, reverse=True), step_tokens
        self.next_sequence = self.next_step = task << 40
        self.open: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self.steps: dict[int, int] = {}  # open step group -> tokens it still takes
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        at, total, longest = 0, len(ids), self.tiers[0]
        while total - at >= longest:
            self.close([self.piece(doc_id, ids, at, at + longest)], longest)
            at += longest
        if at < total:
            tier = min(t for t in self.tiers if t >= total - at)
            room = tier - sum(p[2] for p in self.open[tier])
            end = min(total, at + room)
            self.open[tier].append(self.piece(doc_id, ids, at, end))
            if end - at == room:
                self.close(self.open[tier], tier)
                self.open[tier] = [self.piece(doc_id, ids, end, total)] if end < total else []

    @staticmethod
    def piece(doc_id, ids: np.ndarray, start: int, end: int) -> tuple:
        return doc_id, start, end - start, ids[start:end], len(ids)

    def close(self, pieces: list[tuple], tier: int) -> None:
        """Write out a window and deal it to the first open step group with room for it."""
        used = sum(p[2] for p in pieces)
        step = next((s for s, room in self.steps.items() if room >= tier), None)
        if step is None:
            step, self.next_step = self.next_step, self.next_step + 1
            self.steps[step] = self.step_tokens
        self.steps[step] -= tier
        if not self.steps[step]:
            del self.steps[step]
        offset = 0
        for doc_id, start, length, ids, total in pieces:
            self.rows.append((doc_id, start, length, zlib.crc32(ids.astype("<u4").tobytes()), total, self.next_sequence, offset, tier, step))
            offset += length
        assert offset == used <= tier
        self.next_sequence += 1

    def finish(self) -> None:
        """Fill the long windows' gaps from the shorter tiers, then cut the rest into powers of two."""
        rest = [p for t in self.tiers for p in self.open[t]]
        self.open = {t: [] for t in self.tiers}
        while left := sum(p[2] for p in rest):
            size = min(self.tiers[0], 1 << (left.bit_length() - 1))
            window: list[tuple] = []
            while (room := size - sum(p[2] for p in window)) > 0:
                doc_id, start, length, ids, total = rest.pop(0)
                take = min(room, length)
                window.append((doc_id, start, take, ids[:take], total))
                if take < length:
                    rest.insert(0, (doc_id, start + take, length - take, ids[take:], total))
            self.close(window, size)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 9
        self.rows = []
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", tiers: tuple[int, ...] = TIERS, end_id: int = 0, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece of a document in a packed sequence.

    Each input partition is packed by its own task in a single pass: no text and no token is
    shuffled, memory holds the open windows only, and a rerun of a lost task gives the same pieces
    because it reads the same rows. A document is the ids of its text (null: empty) and end_id. All
    windows are full: their sizes are the tiers and, for the last few tokens of a task, smaller
    powers of two. `tier` is a sequence's size and `step_group` its group of step_tokens tokens;
    windows are dealt to the first open group with room, so all groups of a task but its last few
    hold step_tokens exactly. sequence_id and step_group begin with the number of the input
    partition: the same splits give the same numbers, other splits give other ones.
    Repeated rows are packed as often as they occur, null ids are kept, an empty table gives no
    pieces, and extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer, encode = Packer(context.partitionId() if context else 0, tiers, step_tokens), encoder(tokenizer_path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, 1):
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    packer.add(doc_id, np.concatenate([encode(body.decode("utf-8", "replace")), end]))
                yield packer.take()
        packer.finish()
        yield packer.take()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("body"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long")
