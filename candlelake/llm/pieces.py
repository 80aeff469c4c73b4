"""SentencePiece encoding and decoding that keeps the place of every piece in the original text.

The model file is read by a small reader of its wire format. A text is normalised by longest
prefixes of the compiled character map, and every normalised byte remembers the original byte it
comes from; byte-pair merges then work on the normalised text, and the ends of every piece are
projected back to original byte offsets.

No piece of a supported model has a space mark after another character, so merges never cross
such a place: a text is cut there, and the pieces of recurring chunks are kept in a bounded table
in each Python worker.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KEPT_CHUNKS = 350_000        # chunks whose pieces a worker remembers, twice
LONGEST_KEPT = 40            # characters of a remembered chunk

# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double array over UTF-8 prefixes, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix at ``at``, and what replaces it."""
        if not self.units:
            return None
        found, unit = None, self.units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start:self.texts.index(b"\0", start)]


class PieceCoder:
    """Encoder and decoder of one byte-pair model with byte fallback."""

    def __init__(self, model: bytes):
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != BPE or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds:
            raise ValueError("only byte-pair models with byte fallback and without user symbols are supported")
        if trainer.get(24, 0):
            raise ValueError("models with the space mark as a suffix are not supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.map = CharacterMap(normalizer.get(2, b""))
        self.prefix, self.trim = bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        if not normalizer.get(5, 1):
            raise ValueError("models that keep spaces as they are are not supported")
        self.rank = {text: -score for text, score, kind in pieces if kind == NORMAL}
        self.id = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self._tables()
        self.width = np.array([len(text.encode()) if kind == NORMAL else 1 for text, _, kind in pieces], np.int64)
        self.byte_id, self.byte = [0] * 256, [-1] * len(pieces)
        self.surface = [text.replace(SPACE, " ") for text, _, _ in pieces]
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[i] = int(text[3:5], 16)
                self.byte_id[self.byte[i]] = i
                self.surface[i] = chr(self.byte[i])
            elif kind == CONTROL:
                self.surface[i] = ""
            elif kind == UNKNOWN:
                self.surface[i] = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.in_part = np.array([b >= 0x80 for b in self.byte])
        self.silent = np.array([kind == CONTROL for _, _, kind in pieces])
        inside = {c for text in self.rank if len(text) > 1 for c in text}
        if any(re.search(f"[^{SPACE}]{SPACE}", text) for text in self.rank):
            self.chunk = re.compile(r".+", re.S)
        else:    # a line break that no longer piece holds is a cut too
            broken = "" if "\n" in inside else "\\n"
            self.chunk = re.compile(f"{SPACE}*[^{SPACE}{broken}]+|{SPACE}+|\\n+", re.S)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normalize(self, text: str) -> tuple[str, np.ndarray | None]:
        """The normalised text, and for each of its bytes and its end the original byte offset.

        The offsets are None where they follow from the text: nothing is mapped or trimmed.
        """
        if not text:
            return "", None
        if not self.map.units and not self.trim:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), None
        data, out, source, at = text.encode(), bytearray(), [], 0
        mark = SPACE.encode()
        spaced = self.trim       # drop spaces at the start and after a space
        steps = []
        while at < len(data):
            step = self.map.longest(data, at)
            if step is None:
                size = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                step = size, data[at:at + size]
            steps.append((at, step[1]))
            at += step[0]
        if self.trim:            # mapped texts of only spaces at either end vanish
            while steps and not steps[0][1].strip(b" "):
                steps.pop(0)
        if self.prefix and steps:
            out += mark
            source += [steps[0][0]] * 3
        end = len(data)
        spaced = self.trim
        for start, replaced in steps:
            if spaced:
                replaced = replaced.lstrip(b" ")
            if not replaced:
                continue
            for byte in replaced:
                got = mark if byte == 32 else bytes((byte,))
                out += got
                source += [start] * len(got)
            spaced = self.trim and replaced.endswith(b" ")
        while self.trim and out.endswith(mark):
            del out[-3:]
            end = source[-3]
            del source[-3:]
        return out.decode(), np.array([*source, end], np.int64)

    def _tables(self) -> None:
        """For merges by number: single characters, and what each pair of pieces gives.

        A pair's value is ``order << 16 | id``, and orders follow the scores. Pieces that share a
        score are left to ``_merge``, where the leftmost pair wins.
        """
        shared = {s for s, n in Counter(self.rank.values()).items() if n > 1}
        tied = [re.escape(text) for text, s in self.rank.items() if s in shared and len(text) > 1]
        self.tied = re.compile("|".join(tied)) if tied else None
        order = {s: i for i, s in enumerate(sorted(set(self.rank.values())))}
        self.single = {text: i for text, i in self.id.items() if len(text) == 1}
        self.pair = {}
        for text, i in self.id.items():
            for cut in range(1, len(text)):
                a, b = self.id.get(text[:cut]), self.id.get(text[cut:])
                if a is not None and b is not None:
                    self.pair[a << 16 | b] = order[self.rank[text]] << 16 | i
        self.near = {a + b for text in self.id for a, b in zip(text, text[1:])}

    def _merge_ids(self, ids: list[int]) -> list[int]:
        """Merges of a chunk of known characters without tied scores."""
        get, none = self.pair.get, 1 << 60
        scores = [get(a << 16 | b, none) for a, b in zip(ids, ids[1:])]
        while scores:
            best = min(scores)
            if best == none:
                break
            i = scores.index(best)
            ids[i] = best & 0xFFFF
            del ids[i + 1], scores[i]
            if i < len(scores):
                scores[i] = get(ids[i] << 16 | ids[i + 1], none)
            if i:
                scores[i - 1] = get(ids[i - 1] << 16 | ids[i], none)
        return ids

    def _merge(self, chunk: str) -> list[str]:
        """Byte-pair merges of any chunk: the best score first, then the leftmost pair."""
        rank, parts = self.rank, list(chunk)
        size = len(parts)
        left, right = list(range(-1, size - 1)), [*range(1, size), -1]
        heap = [(rank[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j], right[i] = joined, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and parts[a] + parts[b] in rank:
                    heapq.heappush(heap, (rank[parts[a] + parts[b]], a, parts[a] + parts[b]))
        return [p for p in parts if p is not None]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk as packed integers; remembered for chunks of usual length."""
        got = self.older.get(chunk)
        if got is None:
            got = self._work_out(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self.known) >= KEPT_CHUNKS:      # forget what was not used since the last time
                self.older = dict(self.known)
                self.known.clear()
            self.known[chunk] = got
        return got

    def _work_out(self, chunk: str) -> bytes:
        near = self.near
        if len(chunk) > 2 and chunk[-2:] not in near and (head := self.known.get(chunk[:-1])):     # a known word and a sign
            return head + (self.known.get(chunk[-1]) or self._chunk(chunk[-1]))
        cuts = [i for i, (a, b) in enumerate(zip(chunk, chunk[1:]), 1) if a + b not in near]
        if cuts:      # no piece joins the two characters at a cut, and the parts have no cut
            known, work = self.known, self._chunk
            parts = (chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)]))
            return b"".join([known.get(part) or work(part) for part in parts])
        ids = list(map(self.single.get, chunk))
        if len(ids) <= 100 and None not in ids and not (self.tied and self.tied.search(chunk)):
            return array("I", self._merge_ids(ids)).tobytes()
        ids = []
        for part in self._merge(chunk):
            i = self.id.get(part)      # a single character that is no piece gives its bytes
            ids += [self.byte_id[b] for b in part.encode()] if i is None else [i]
        return array("I", ids).tobytes()

    def ids(self, normal: str) -> np.ndarray:
        """Ids of a normalised text, without marks."""
        known, work = self.known, self._chunk
        return np.frombuffer(b"".join([known.get(c) or work(c) for c in self.chunk.findall(normal)]), "<u4")

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end marks, and the original byte span of each. Null counts as empty."""
        text = text or ""
        normal, source = self.normalize(text)
        ids = self.ids(normal)
        ends = np.cumsum(self.width[ids], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        if source is None:
            starts, ends = self._plain_spans(text, normal, starts, ends)
        else:
            starts, ends = source[starts], source[ends]
        size = len(text.encode())
        return (np.concatenate([[self.begin], ids, [self.end]]).astype(np.uint32),
                np.concatenate([[0], starts, [size]]), np.concatenate([[0], ends, [size]]))

    def _plain_spans(self, text, normal, starts, ends):
        """Original offsets where only spaces became marks: a mark of three bytes stands for one."""
        raw = np.frombuffer(normal.encode(), np.uint8)
        marks = np.zeros(len(raw) + 1, np.int64)
        at = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81))
        if SPACE in text:      # marks of the text itself keep their three bytes
            spaces = np.frombuffer(re.sub(f"[^ {SPACE}]", "", text).replace(SPACE, "x").encode(), np.uint8) == 32
            at = at[int(self.prefix):][spaces]
        marks[at] = 2
        if self.prefix and len(raw):
            marks[0] = 3
        lost = np.concatenate([[0], np.cumsum(marks[:-1])]) if len(raw) else marks
        return starts - lost[starts], ends - lost[ends]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.asarray(ids, np.int64)
        if self.in_part[ids].any():      # bytes of longer characters have to be put together
            out, raw = [], bytearray()
            for i in ids.tolist():
                if self.byte[i] >= 0:
                    raw.append(self.byte[i])
                    continue
                if raw:
                    out.append(raw.decode("utf-8", "replace"))
                    raw.clear()
                out.append(self.surface[i])
            out.append(raw.decode("utf-8", "replace"))
        else:
            out = map(self.surface.__getitem__, ids.tolist())
        text, first = "".join(out), ids[~self.silent[ids]][:1]
        lead = self.prefix and len(first) and self.byte[first[0]] < 0 and self.surface[first[0]].startswith(" ")
        return text[1:] if lead else text

    def digest(self, text: str | None) -> tuple[int, str, str, int]:
        """Number of ids, SHA-256 of ids and of the decoded text, and sum of the pieces' end offsets."""
        ids, _, ends = self.encode(text)
        return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest(), int(ends.sum()))


@lru_cache(maxsize=2)
def _coder(model: bytes) -> PieceCoder:
    """One coder per model and Python worker: chunks stay known from task to task."""
    return PieceCoder(model)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, ``ids``, ``starts``, ``ends``: pieces and their original byte spans.

    One row per row of ``docs``, repeated rows included; a null text counts as empty and gives the
    begin and end marks. Other columns are left out, whatever their names. No shuffle.
    """
    @F.pandas_udf("ids array<int>, starts array<int>, ends array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = _coder(model)
        for texts in parts:
            yield pd.DataFrame([[x.astype(np.int32) for x in coder.encode(t)] for t in texts],
                               columns=["ids", "starts", "ends"])

    return docs.select(id_col, run(text_col).alias("r")).select(id_col, "r.*")


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``; null ids give a null text."""
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _coder(model)
        for rows in parts:
            yield pd.Series([None if ids is None else coder.decode(ids) for ids in rows], dtype=object)

    return encoded.withColumn("decoded", run(ids_col))


def digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``encode`` and ``decode`` give, as counts and hashes: the arrays never leave the task.

    ``end_offsets`` is the sum of the end offsets of all pieces.
    """
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, end_offsets long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = _coder(model)
        for texts in parts:
            yield pd.DataFrame([coder.digest(t) for t in texts],
                               columns=["n_tokens", "ids_sha256", "decoded_sha256", "end_offsets"])

    return docs.select(id_col, run(text_col).alias("r")).select(id_col, "r.*")
