"""Hierarchical packing of tokenised documents into windows of several lengths.

A document's ids end with a separator. Full windows are cut off first; what is left goes to the smallest tier (a power of two)
that holds it. From the longest tier to the shortest, each piece opens a window of its tier and the gap behind it is
filled from the shortest tiers, the last piece being cut to fit. Windows for which no filler is left are cut again from
one stream into long windows and, at its end, shorter tiers, so that at most one window of a packing group needs padding.
Sequences are dealt to steps of equal size in a snake order of their attention cost, so that steps cost about the same.

Packing needs no shuffle: a group is what one task has read until it holds `group_tokens` ids, which also bounds memory
(besides a single longer document). Null text counts as empty, so every document has at least its separator. Null ids,
repeated documents and extra columns are kept apart by row; nothing is dropped.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tideway.llm.common import released

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, "
          "tier int, step_group long")
TIERS = (2048, 1024, 512, 256)


class Words(dict):
    """Token bytes by blank-free stretch of text. Words are the units of the tokenizer's merges, so a text's ids are those of its
    stretches in turn; most stretches occur again and again, and `room` bounds how many are kept."""

    def __init__(self, path: str, room: int = 700_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.room = self.tokenizer.model, room
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.bytes = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.bytes)
        return np.array([t.id for t in self.model.tokenize(word)], dtype="<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        core = chunk.rstrip(".,;:!?")
        if core == "" or not core.isalpha() or core != core.lower() or not unicodedata.is_normalized("NFC", core):
            out = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes() if chunk else b""
        elif core == chunk:
            out = self._word(core)
        else:
            out = self[core] + self[chunk[len(core):]]
        if len(self) < self.room:
            self[chunk] = out
        return out

    def ids(self, text: str | None, end: int) -> np.ndarray:
        text = text or ""
        if "<|" not in text and "Σ" not in text and "İ" not in text:
            text = text.lower()
        joined = b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        return np.frombuffer(joined + np.uint32(end).tobytes(), dtype="<u4")


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows (size, [(document, start, length), …]) that hold documents of these lengths."""
    longest, full, open_, windows = tiers[0], {t: deque() for t in tiers}, [], []

    def route(doc: int, start: int, n: int) -> None:
        full[min(t for t in tiers if t >= n)].append((doc, start, n))

    for doc, n in enumerate(lengths):
        whole = n - n % longest
        windows += [(longest, [(doc, s, longest)]) for s in range(0, whole, longest)]
        if n > whole:
            route(doc, whole, n - whole)
    for t in tiers:
        shorter = [x for x in reversed(tiers) if x < t]
        while full[t]:
            window = [full[t].popleft()]
            gap = t - window[0][2]
            while gap:
                source = next((full[x] for x in shorter if full[x]), None) or (full[t] if t == tiers[-1] and full[t] else None)
                if source is None:
                    break
                doc, start, n = source.popleft()
                take = min(n, gap)
                window.append((doc, start, take))
                gap -= take
                if n > take:
                    route(doc, start + take, n - take)
            (open_ if gap else windows).append((t, window))
    stream = deque(p for _, w in open_ for p in w)
    left = sum(p[2] for p in stream)
    while left:
        size = next((t for t in tiers if t <= left), longest)
        window, room = [], size
        while room and stream:
            doc, start, n = stream.popleft()
            take = min(n, room)
            window.append((doc, start, take))
            room -= take
            left -= take
            if n > take:
                stream.appendleft((doc, start + take, n - take))
        windows.append((size, window))
    return windows


def pack_documents(docs: DataFrame, tokenizer: str, *, end: int = 1, tiers: tuple[int, ...] = TIERS, group_tokens: int = 2_000_000,
                   step_sequences: int = 64) -> DataFrame:
    """One row per piece, see SCHEMA; a sequence shorter than its tier is to be padded to the longest one."""

    def run(batches):
        words, held, tokens, groups, sequences = Words(tokenizer), [], 0, 0, 0
        first = TaskContext.get().partitionId() << 40

        def emit():
            nonlocal groups, sequences
            windows = pack([len(ids) for _, ids in held], tiers)
            cost = [sum(n * n for _, _, n in w) for _, w in windows]
            steps, step_of = -(-len(windows) // step_sequences), [0] * len(windows)
            for k, i in enumerate(sorted(range(len(windows)), key=lambda i: -cost[i])):
                lap, at = divmod(k, steps)
                step_of[i] = at if lap % 2 == 0 else steps - 1 - at
            rows = []
            for i, (size, window) in enumerate(windows):
                offset = 0
                for doc, start, n in window:
                    doc_id, ids = held[doc]
                    rows.append((doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids), first + sequences + i, offset, size,
                                 first + groups + step_of[i]))
                    offset += n
            sequences += len(windows)
            groups += steps
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
            out = pd.DataFrame(rows, columns=columns)
            return out.astype({"doc_id": "Int64"})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].array, batch["text"], strict=True):
                ids = words.ids(text, end)
                held.append((None if pd.isna(doc_id) else int(doc_id), ids))
                tokens += len(ids)
                if tokens >= group_tokens:
                    yield emit()
                    held, tokens = [], 0
        if held:
            yield emit()

    return docs.select("doc_id", "text").mapInPandas(released(run), SCHEMA)
