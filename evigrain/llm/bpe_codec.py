"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over 16 bytes cuts each text where its low bits are zero, so a passage that many documents share is cut alike
in all of them. A worker encodes each chunk once and remembers its inner ids and their decoded
text; each later document with that chunk takes them. What stands at a chunk's edges, up to the
first and the last blank, may be part of a word that goes on in the next chunk. A join is repaired
by encoding what meets there as one with a whole word on either side; if those words do not come out as
they do alone, the text is encoded as one.

Nothing moves between machines: sending ids would cost more than making them, so "once" holds for
a worker, within REMEMBERED chunks. Results are those of the tokenizers library for the whole text.

Nulls and edges: a null text counts as empty (no ids, empty decoded text); a null doc_id stays
null; repeated rows give repeated rows; texts with an added token's own text go to the library whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from .textops import U64, _powers, mix

#: Bytes of the rolling hash's window; mean, least and largest bytes of a chunk; chunks and words that a worker remembers.
WINDOW, MEAN, LEAST, MOST, REMEMBERED, WORDS = 16, 1024, 256, 4096, 6000, 400_000
# fixed values: letters and blanks that the pre-tokenizer's pattern tells apart, of ASCII and the first two Latin blocks
_LETTERS, _BLANKS = "A-Za-zÀ-ÖØ-öø-įı-ſ", "\t-\r "
_ODD = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_BLANKS}{_LETTERS}0-9]+")
_STRIP = " \t\n\x0b\x0c\r"
_GAP = re.compile(rf"[{_BLANKS}]+")
#: The pre-tokenizer pattern that the shortcut above stands for.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts(data: np.ndarray) -> np.ndarray:
    """Where the chunks of a text end."""
    n = len(data)
    found = []
    step = 1 << 17
    for at in range(0, max(0, n - WINDOW + 1), step):
        part = data[at : min(n, at + step + WINDOW - 1)]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum((part.astype(U64) + U64(1)) * _powers(len(part))[: len(part)], out=total[1:])
        h = mix((total[WINDOW:] - total[:-WINDOW]) * _powers(len(part), inverse=True)[: len(part) - WINDOW + 1])
        found.append(np.flatnonzero((h & U64(MEAN - 1)) == 0) + at + WINDOW)
    marks = np.concatenate(found) if found else np.empty(0, np.int64)
    marks = marks[(marks < n)]
    marks = marks[(data[marks] & 0xC0) != 0x80] if len(marks) else marks
    out, last, k = [], 0, 0
    while n - last > MOST or k < len(marks):
        while k < len(marks) and marks[k] - last < LEAST:
            k += 1
        if k < len(marks) and marks[k] - last <= MOST:
            end = int(marks[k])
            k += 1
        elif n - last > MOST:
            end = last + MOST
            while end < n and (data[end] & 0xC0) == 0x80:
                end += 1
            if end >= n:
                break
        else:
            break
        out.append(end)
        last = end
    return np.array([*out, n], np.int64)


class JoinError(Exception):
    """The words around a join depend on it, so the text has to be encoded as one."""


class ChunkCodec:
    """Encodes and decodes whole texts with the file of a BPE tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        kept = json.loads(self.library.to_str())
        self.added = [t["content"] for t in kept["added_tokens"]]
        pre = json.dumps(kept["pre_tokenizer"] or {})
        # blanks end words here, and case and blanks are all that normalising changes in the texts of the shortcut
        self.splits = json.dumps(_PATTERN)[1:-1] in pre and '"invert": true' in pre and '"Removed"' in pre and "Lowercase" in json.dumps(kept["normalizer"])
        self.joined = kept["decoder"] is None
        self.token = [(self.library.id_to_token(i) or "").encode() for i in range(self.library.get_vocab_size())]
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.encoded = self.reused = self.widened = 0

    def run(self, ids: list[int]) -> tuple[bytes, bytes]:
        """(ids, decoded text) as bytes."""
        return np.array(ids, "<u4").tobytes(), b" ".join([self.token[i] for i in ids])

    def plain(self, text: str) -> tuple[bytes, bytes]:
        """Ids and decoded text of a run of text that stands alone between blanks."""
        if _ODD.search(text):
            return self.run(self.library.encode(text, add_special_tokens=False).ids)
        words = _WORD.findall(text.lower())
        for w in words:
            if w not in self.ids:
                self.ids[w], self.decoded[w] = self.run(self.library.encode(w, add_special_tokens=False).ids)
        return b"".join(map(self.ids.__getitem__, words)), b" ".join(map(self.decoded.__getitem__, words))

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet, in one call."""
        if len(self.ids) > WORDS:
            self.ids, self.decoded = {}, {}
        fresh = list(words.difference(self.ids))
        ids, decoded, token = self.ids, self.decoded, self.token
        for w, e in zip(fresh, self.library.encode_batch_fast(fresh, add_special_tokens=False) if fresh else [], strict=True):
            got = e.ids
            ids[w], decoded[w] = array("I", got).tobytes(), b" ".join([token[i] for i in got])

    def parts(self, raw: bytes) -> tuple:
        """(head, inner, words of inner or None, tail, first inner word, last inner word): head and tail may go on in the neighbours."""
        text = raw.decode()
        first = _GAP.search(text)
        if first is None:
            return text, None, None, "", "", ""
        last = max(text.rfind(c) for c in _STRIP)
        inner = text[first.end() : last] if last > first.end() else ""
        edge = inner.strip(_STRIP)
        lead = _GAP.split(edge, maxsplit=1)[0] if edge else ""
        tail = edge[max(edge.rfind(c) for c in _STRIP) + 1 :]
        return text[: first.start()], inner, None if _ODD.search(inner) else _WORD.findall(inner.lower()), text[last + 1 :], lead, tail

    def prepare(self, texts: list[str]) -> list[list[bytes] | None]:
        """The chunks of each text, those that are new encoded; None for a text that goes to the library whole."""
        out: list[list[bytes] | None] = []
        fresh: dict[bytes, tuple] = {}
        for text in texts:
            if not self.splits or any(a in text for a in self.added):
                out.append(None)
                continue
            raw, at, mine = text.encode(), 0, []
            for end in cuts(np.frombuffer(raw, np.uint8)).tolist():
                mine.append(raw[at:end])
                at = end
            for c in mine:
                if c in self.chunks or c in fresh:
                    self.reused += 1
                else:
                    fresh[c] = self.parts(c)
                    self.encoded += 1
            out.append(mine)
        self.learn({w for p in fresh.values() if p[2] for w in p[2]})
        if len(self.chunks) + len(fresh) > REMEMBERED:  # what is at hand and what came last stay
            here = {c for mine in out if mine for c in mine}
            kept = [c for c in self.chunks if c not in here][len(fresh) + len(here) - REMEMBERED :] if len(fresh) + len(here) < REMEMBERED else []
            self.chunks = {c: self.chunks[c] for c in [*kept, *(c for c in here if c in self.chunks)]}
        ids, decoded = self.ids.__getitem__, self.decoded.__getitem__
        for c, (head, inner, words, tail, first, last) in fresh.items():
            if words is None:
                made = None if inner is None else self.plain(inner)
            else:
                made = b"".join(map(ids, words)), b" ".join(map(decoded, words))
            self.chunks[c] = (head, made, tail, first, last)
        return out

    def repair(self, middle: str, before: str, after: str) -> tuple[bytes, bytes]:
        """What meets at a join, encoded with the words on either side, which must come out as they do alone."""
        if not middle:
            return b"", b""
        a, b = self.plain(before)[0], self.plain(after)[0]
        whole, decoded = self.plain(" ".join(x for x in (before, middle, after) if x))
        end = len(whole) - len(b)
        if whole[: len(a)] == a and whole[end:] == b and end >= len(a):
            return self.run(np.frombuffer(whole[len(a) : end], "<u4").tolist())
        self.widened += 1
        raise JoinError

    def coded(self, text: str, chunks: list[bytes] | None) -> tuple[int, str, str]:
        """(count of ids, digest of ids, digest of the decoded text) of one text with its prepared chunks."""
        if chunks is not None:
            try:
                ids, decoded = self.by_chunks(chunks)
            except JoinError:
                ids, decoded = self.run(self.library.encode(text, add_special_tokens=False).ids)
            if not self.joined:
                decoded = self.library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False).encode()
        else:
            got = self.library.encode(text, add_special_tokens=False).ids
            ids, decoded = np.array(got, "<u4").tobytes(), self.library.decode(got, skip_special_tokens=False).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def texts(self, texts: list[str]) -> list[tuple[int, str, str]]:
        return [self.coded(t, c) for t, c in zip(texts, self.prepare(texts), strict=True)]

    def text(self, text: str) -> tuple[int, str, str]:
        return self.texts([text])[0]

    def by_chunks(self, chunks: list[bytes]) -> tuple[bytes, bytes]:
        runs, held, near = [], "", ""
        for c in chunks:
            head, inner, tail, first, last = self.chunks[c]
            if inner is None:
                held += head
                continue
            runs.append(self.repair(held + head, near, first))
            runs.append(inner)
            held, near = tail, last
        runs.append(self.repair(held, near, ""))
        runs = [r for r in runs if r[0]]
        return b"".join(r[0] for r in runs), b" ".join(r[1] for r in runs)


@lru_cache(maxsize=2)
def codec(path: str) -> ChunkCodec:
    return ChunkCodec(path)


def _coded(path: str):
    def run(batches):
        me = codec(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for i in range(0, len(texts), 64):
                rows += me.texts(texts[i : i + 64])
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of docs (doc_id, text)."""
    base.tune(docs.sparkSession)
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_coded(tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
