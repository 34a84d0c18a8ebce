"""Byte-level BPE on whole words: splitting text, exact merges, decoding. Vocabulary files are parameters."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

#: Words of more bytes are merged one by one.
LONG_WORD = 200
NO_RANK = 1 << 40
LETTER, NUMBER, SPACE, OTHER, EDGE = 1, 2, 3, 4, 9
#: Code points of the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(1)
def char_classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        kind = major.get(unicodedata.category(chr(cp))[0])
        if kind:
            kinds[cp] = kind
    kinds[WHITE_SPACE] = SPACE
    return kinds


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_starts(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the words of joined texts start, as the usual byte-level pattern splits each text:
    contractions, then letters, numbers or other characters with one leading blank, then white space
    that leaves its last character to the next word. ``text_starts``: starts of the non-empty texts.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    kind = char_classes()[codes]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = EDGE, kind[:-1]
    before[text_starts] = EDGE
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = EDGE, kind[1:]
    after[text_starts[1:] - 1] = EDGE
    blank = np.zeros(n, bool)
    blank[1:] = codes[:-1] == 32
    blank &= before != EDGE
    space = kind == SPACE
    start = np.where(space, (before != SPACE) | ((after != SPACE) & (after != EDGE)), (before != kind) & ~blank)
    at = np.flatnonzero((codes == 39) & (before != OTHER) & ~blank & (after == LETTER))
    if len(at):
        end = np.append(text_starts[1:], n)[np.searchsorted(text_starts, at, "right") - 1]
        one = codes[at + 1]
        two = np.where(at + 2 < end, codes[np.minimum(at + 2, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 3, size)
        at, size, end = at[size > 0], size[size > 0], end[size > 0]
        start[at + 1] = False
        inside = at + size < end
        start[(at + size)[inside]] = True
    return np.flatnonzero(start)


class Bpe:
    """A byte-level BPE vocabulary: merges, byte ids, token bytes and special tokens."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab = model["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown, extra = {b: chr(b) for b in printable}, 256
        for b in range(256):
            if b not in shown:
                shown[b] = chr(extra)
                extra += 1
        raw = {c: b for b, c in shown.items()}
        self.byte_ids = [vocab[shown[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = {i: bytes(raw[c] for c in t) if all(c in raw for c in t) else t.encode() for i, t in names.items()}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << 20 | vocab[b]] = (rank, vocab[a + b])
        self.byte_table = np.array(self.byte_ids, np.int64)
        self.keys = np.array(sorted(self.merges), np.int64)
        self.rank_of = np.array([self.merges[k][0] for k in self.keys.tolist()], np.int64)
        self.made_by = np.array([made for _, made in self.merges.values()], np.int64)

    def merge(self, word: bytes) -> list[int]:
        """Exact merges of one word: the pair of lowest rank first, leftmost first. Near-linear, for words of any length."""
        ids, merges, n = [self.byte_ids[b] for b in word], self.merges, len(word)
        left, right = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(*m, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := merges.get(a << 20 | b))]
        heapify(heap)
        while heap:
            _, made, i, a, b = heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = made, -1, right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (m := merges.get(ids[x] << 20 | ids[y])):
                    heappush(heap, (*m, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or NO_RANK."""
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words: those of one length advance together, one merge a round."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            if size > LONG_WORD:
                for i in rows:
                    out[i] = pack_ids(self.merge(words[i]))
            elif size:
                self._merge_block(words, np.array(rows), size, out)
        return out

    def _merge_block(self, words: list[bytes], rows: np.ndarray, size: int, out: list[bytes]) -> None:
        ids = self.byte_table[np.frombuffer(b"".join(words[i] for i in rows), np.uint8)].reshape(-1, size)
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        while True:
            m = ids.shape[1]
            at = rank.argmin(1) if m > 1 else np.zeros(len(ids), np.int64)
            best = rank[np.arange(len(ids)), at] if m > 1 else np.full(len(ids), NO_RANK)
            done = best == NO_RANK
            if done.any():
                flat = ids[done].astype("<u4").tobytes()
                for k, i in enumerate(rows[done].tolist()):
                    out[i] = flat[4 * m * k : 4 * m * (k + 1)]
                ids, rank, rows, at, best = ids[~done], rank[~done], rows[~done], at[~done], best[~done]
            if not len(rows):
                return
            line, step = np.arange(len(rows)), np.arange(m - 1)
            ids = np.take_along_axis(ids, step + (step > at[:, None]), 1)
            ids[line, at] = self.made_by[best]
            rank = np.take_along_axis(rank, step[:-1] + (step[:-1] >= at[:, None]), 1)
            some = at > 0
            x, y = line[some], at[some]
            rank[x, y - 1] = self._rank(ids[x, y - 1], ids[x, y])
            some = at < m - 2
            x, y = line[some], at[some]
            rank[x, y] = self._rank(ids[x, y], ids[x, y + 1])

    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids; broken byte sequences become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def pack_ids(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class Encoder:
    """Encodes texts word by word. ``resolve`` gives the ids of new words; two bounded tables keep them.

    When the newer table is full it becomes the older one, and words that are met again move back, so frequent words stay.
    """

    def __init__(self, bpe: Bpe, resolve: Callable[[list[str]], list[bytes]] | None = None, keep: int = 200_000):
        self.bpe, self.keep, self.known, self.older = bpe, keep, {}, {}
        self.resolve = resolve or self.merged

    def merged(self, words: list[str]) -> list[bytes]:
        return self.bpe.merge_many([w.encode("utf-8", "surrogatepass") for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text. Special tokens inside a text become their ids."""
        marked = {i for i, t in enumerate(texts) if any(s in t for s in self.bpe.special)}
        out = self._plain([t for i, t in enumerate(texts) if i not in marked])
        if not marked:
            return out
        rest = iter(out)
        return [self._with_special(t) if i in marked else next(rest) for i, t in enumerate(texts)]

    def _with_special(self, text: str) -> bytes:
        found = [(text.find(s), s) for s in self.bpe.special if s in text]
        if not found:
            return self._plain([text])[0]
        parts = []
        while found:
            at, mark = min(found)
            parts += [self._plain([text[:at]])[0], pack_ids([self.bpe.special[mark]])]
            text = text[at + len(mark) :]
            found = [(text.find(s), s) for s in self.bpe.special if s in text]
        return b"".join([*parts, self._plain([text])[0]])

    def _plain(self, texts: list[str]) -> list[bytes]:
        joined = "".join(texts)
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        starts = word_starts(code_points(joined), np.unique(bounds[:-1][bounds[:-1] < bounds[1:]]))
        edges = [*starts.tolist(), len(joined)]
        words = [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        if len(self.known) > self.keep:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        ids = list(map(known.get, words))
        missing = [i for i, found in enumerate(ids) if found is None]
        if missing:
            fresh = {words[i] for i in missing}
            again = {w: older[w] for w in fresh if w in older}
            new = [w for w in fresh if w not in again]
            known.update(again)
            known.update(zip(new, self.resolve(new), strict=True))
            for i in missing:
                ids[i] = known[words[i]]
        cuts = np.searchsorted(starts, bounds).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
