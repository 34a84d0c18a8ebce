"""Language-model scoring by causal self-attention over subword ids, in numpy.

A text (A to Z in lower case) is encoded with a given vocabulary and ends with an end mark. Frequent ids are classes of
their own, the others share classes, finer ones where they are read than where they are predicted; the attention model
predicts the next class from those before it, and an id's share of its class comes from its counts, after the id
before it and at all. Long texts are cut into windows that overlap; each token is scored once, in the
first window that holds it, with at least ``OVERLAP`` tokens of context after the first window.

Word, id and pair counts cover all training texts. The weights start from a fit on windows drawn evenly from all training
texts and are then trained on every window of every training text, in rounds whose number grows with the logarithm of
the tokens: a round deals a share of all texts over all tasks, each trains on its own, then the weights are averaged and
the next round starts from them.

Frequent pairs (a bounded list) are looked up in the tasks; the counts of all other pairs come back by a join. The base score is a smoothed word unigram. Frequent words (a bounded list) are looked up in the tasks; counts of all other
words come back by a join on word hashes.

Defined cases: a null text is empty and is scored as its end mark; a null doc_id belongs to the training texts; repeated
rows are scored each; without training texts the model is uniform over classes; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import Bpe, Encoder, default_vocabulary
from logloom.llm.common import chunks, claim, map_rows, saved
from logloom.llm.order_minhash import GOLD, U, _mix

#: Ids with a class of their own and shared classes: predicted, read.
OWN, SHARED = 88, 40
CLASSES = OWN + SHARED
READ_OWN, READ_SHARED = 1984, 64
WINDOW, OVERLAP, WIDTH, HIDDEN = 24, 6, 24, 48
SCALE = np.float32(WIDTH**-0.5)
#: Exponents stay below this, so sums stay finite.
LARGEST = np.float32(60)
#: A pair (id after a read class) is looked up in the tasks from this share of the tokens on (at most 5,000,000); weight of the plain share.
PAIR_SHARE, PLAIN = 2e-7, 10.0
#: Windows scored at once.
BATCH = 64
#: Windows a rate of the first fit, and rates of both fits.
FIT_WINDOWS, RATES, REFINE_RATE, SEED = 12_000, (0.02, 0.02, 0.01, 0.004, 0.001), 3e-4, 11
#: Rounds up to so many tokens, and rounds more for each doubling of them.
ROUND_TOKENS, ROUNDS, MORE_ROUNDS = 100_000_000, 4, 2
#: Tokens worked on at once.
STEP_TOKENS = 200_000
#: Pairs counted in a task before they are put out.
KEPT_PAIRS = 1_000_000
#: A word is looked up in the tasks from this share of the training tokens on: at most 1,000,000 words.
FREQUENT = 1e-6
KEPT_WORDS = 1_000_000
END = b"\n"  # no word holds it
#: Sums of weights that reach the driver in a round.
GROUPS = 16


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


class Attention:
    """One layer of causal attention and a feed-forward step, each with a residual."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(SEED)
        shapes = {"emb": (READ_OWN + READ_SHARED, WIDTH), "pos": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH), "w1": (WIDTH, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,)}
        self.w = weights or {n: np.zeros(s, np.float32) if n in ("bias", "b1") else (rng.normal(0, 0.3 if n == "emb" else 0.1 if n == "pos" else s[0] ** -0.5, s)).astype(np.float32) for n, s in shapes.items()}
        self.scratch = np.empty((0, CLASSES), np.float32)
        self.later = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)

    def _attend(self, context: np.ndarray, lead: int = 0) -> tuple[np.ndarray, ...]:
        """Inputs (a row a position), then by window keys, values, and from position ``lead`` on queries and unnormed attention."""
        w = self.w
        x = w["emb"].take(context, 0)
        x += w["pos"]
        x = x.reshape(-1, WIDTH)  # one large product is faster than one a window
        qkv = (x @ self._projections()).reshape(*context.shape, 3 * WIDTH)
        q, k, v = qkv[:, lead:, :WIDTH], qkv[:, :, WIDTH:-WIDTH], qkv[:, :, -WIDTH:]
        a = q @ k.transpose(0, 2, 1)
        a += self.later[lead:]
        if a.size and a.max() > LARGEST:
            np.minimum(a, LARGEST, out=a)
        np.exp(a, out=a)
        return x, q, k, v, a

    @staticmethod
    def _lead(counted: np.ndarray) -> int:
        """Positions that no window of these has to predict at."""
        return 0 if counted[:, :OVERLAP].any() else OVERLAP

    def _projections(self) -> np.ndarray:
        return np.concatenate([self.w["q"] * SCALE, self.w["k"], self.w["v"]], 1)

    def hidden(self, context: np.ndarray, counted: np.ndarray | None = None) -> np.ndarray:
        """States (windows, WINDOW, WIDTH) of class windows, or a row for each counted position only."""
        w, lead = self.w, 0 if counted is None else self._lead(counted)
        x, _, _, v, a = self._attend(context, lead)
        z, total = (a @ v).reshape(-1, WIDTH), a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)
        if counted is not None:
            rows = np.flatnonzero(counted[:, lead:])
            x, z, total = x.take(np.flatnonzero(counted), 0), z.take(rows, 0), total.take(rows)
        z /= total[:, None]
        x += z @ w["o"]
        r = x @ w["w1"]
        r += w["b1"]
        np.maximum(r, 0, out=r)
        x += r @ w["w2"]
        return x.reshape(*context.shape, WIDTH) if counted is None else x

    def log_probs(self, states: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each wanted class."""
        if len(self.scratch) < len(states):  # memory that is used again needs no new pages
            self.scratch = np.empty((len(states), CLASSES), states.dtype)
        logits = np.matmul(states, self.w["out"].astype(states.dtype, copy=False), out=self.scratch[: len(states)])
        logits += self.w["bias"]
        if logits.size and logits.max() > LARGEST:
            np.minimum(logits, LARGEST, out=logits)
        own = logits[np.arange(len(wanted)), wanted].astype(np.float64)
        return own - np.log((np.exp(logits, out=logits) @ np.ones(CLASSES, logits.dtype)).astype(np.float64))

    def gradient(self, context: np.ndarray, wanted: np.ndarray, counted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss of the counted positions; the others are read as context only."""
        w, lead = self.w, self._lead(counted)
        x, q, k, v, a = self._attend(context, lead)
        shape = a.shape[:2]
        a /= (a.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(*shape, 1)
        rows, late = np.flatnonzero(counted), np.flatnonzero(counted[:, lead:])
        z = (a @ v).reshape(-1, WIDTH).take(late, 0)
        h = x.take(rows, 0)
        h += z @ w["o"]
        r = h @ w["w1"]
        r += w["b1"]
        np.maximum(r, 0, out=r)
        g = r @ w["w2"]
        g += h
        p = g @ w["out"]
        p += w["bias"]
        if p.size and p.max() > LARGEST:
            np.minimum(p, LARGEST, out=p)
        np.exp(p, out=p)
        total = p @ np.ones(CLASSES, p.dtype)
        p[np.arange(len(rows)), wanted.ravel()[rows]] -= total
        share = 1 / max(1, len(rows)) / total  # a factor a row, applied where rows are short
        every = np.ones(len(rows), p.dtype)
        dg = p @ w["out"].T
        dg *= share[:, None]
        dr = dg @ w["w2"].T
        dr *= r > 0
        dh = dr @ w["w1"].T
        dh += dg
        d = {"out": (p.T @ (g * share[:, None])).T, "bias": share @ p, "w2": r.T @ dg, "w1": h.T @ dr, "b1": every @ dr, "o": z.T @ dh}
        dz = np.zeros((shape[0] * shape[1], WIDTH), x.dtype)
        dz[late] = dh @ w["o"].T
        dz = dz.reshape(*shape, WIDTH)
        ds = dz @ v.transpose(0, 2, 1)
        ds *= a
        ds -= a * (ds.reshape(-1, WINDOW) @ np.ones(WINDOW, a.dtype)).reshape(*shape, 1)
        down = np.empty((*context.shape, 3 * WIDTH), x.dtype)
        down[:, :lead, :WIDTH] = 0
        np.matmul(ds, k, out=down[:, lead:, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=down[:, :, WIDTH:-WIDTH])
        np.matmul(a.transpose(0, 2, 1), dz, out=down[:, :, -WIDTH:])
        down = down.reshape(-1, 3 * WIDTH)
        d["q"], d["k"], d["v"] = np.split((down.T @ x).T, 3, 1)
        d["q"] = d["q"] * SCALE
        dx = down @ self._projections().T
        dx[rows] += dh
        d["pos"] = dx.reshape(len(context), -1).sum(0).reshape(WINDOW, WIDTH)
        read = context.ravel().astype(np.uint16)
        order = np.argsort(read, kind="stable")
        read = read[order]
        starts = np.flatnonzero(np.append(True, read[1:] != read[:-1])[: len(read)])
        d["emb"] = np.zeros_like(w["emb"])
        if len(starts):
            d["emb"][read[starts]] = np.add.reduceat(dx.take(order, 0), starts, 0)
        return d

    def train(self, context: np.ndarray, wanted: np.ndarray, counted: np.ndarray, rate: float, epochs: int, batch: int = 64, moments: tuple | None = None) -> tuple:
        """Adam on windows; returns its moments and step, from which a later call goes on."""
        flat, at = np.concatenate([x.ravel() for x in self.w.values()]), 0
        for n, x in self.w.items():  # the weights are views of one array, so a step is a few passes over it
            self.w[n] = flat[at : at + x.size].reshape(x.shape)
            at += x.size
        m, s, step = moments or (np.zeros_like(flat), np.zeros_like(flat), 0)
        d, t = np.empty_like(flat), np.empty_like(flat)
        rng = np.random.default_rng(SEED)
        for _ in range(epochs):
            order = rng.permutation(len(context))
            for at in range(0, len(order), batch):
                some, step = order[at : at + batch], step + 1
                found = self.gradient(context[some], wanted[some], counted[some])
                np.concatenate([found[n].ravel() for n in self.w], out=d)
                np.subtract(d, m, out=t)
                t *= 0.1
                m += t
                d *= d
                d -= s
                d *= 0.01
                s += d
                np.multiply(s, 1 / (1 - 0.99**step), out=t)
                np.sqrt(t, out=t)
                t += 1e-8
                np.divide(m, t, out=t)
                t *= rate / (1 - 0.9**step)
                flat -= t
        return m, s, step


def _grouped(counts: np.ndarray, spaced: np.ndarray, own: int, shared: int) -> np.ndarray:
    """A class for every id: the ``own`` most frequent have their own; of the rest, by kind (word start or not), ids of like frequency share one."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    of = np.empty(len(counts), np.int64)
    of[order[:own]] = np.arange(min(own, len(counts)))
    half = shared // 2
    for kind in (0, 1):
        ids = order[own:][spaced[order[own:]] == kind]
        mass = np.cumsum(np.sqrt(counts[ids] + 1.0))
        if len(ids):
            of[ids] = own + kind * half + np.minimum((mass / mass[-1] * half).astype(int), half - 1)
    return of


class Classes:
    """Classes of every id, predicted (``of``) and read (``read``), and an id's share of its predicted class."""

    def __init__(self, counts: np.ndarray, spaced: np.ndarray):
        self.of = _grouped(counts, spaced, OWN, SHARED)
        self.read = _grouped(counts, spaced, READ_OWN, READ_SHARED)
        smooth = counts + 1.0
        self.plain = smooth / np.bincount(self.of, smooth, CLASSES)[self.of]
        none = np.empty(0, np.int64)
        self.after(none, none, none, none)

    def after(self, keys: np.ndarray, counts: np.ndarray, cells: np.ndarray, totals: np.ndarray) -> None:
        """Counts of frequent pairs (a key is read class * ids + id), and totals of all pairs by cell (read class * CLASSES + class)."""
        order = np.argsort(keys)
        self.keys = keys[order]
        self.logs = np.log(counts[order] + PLAIN * self.plain[self.keys % len(self.of)])
        self.unseen = np.log(PLAIN * self.plain)
        self.whole = np.log(np.bincount(cells, totals, (READ_OWN + READ_SHARED) * CLASSES) + PLAIN)

    def looked_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key among the frequent pairs, and whether it is one."""
        if not len(self.keys):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, self.keys[at] == key

    def log_share(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log of each id's share of its class after a read class; a pair that is not looked up counts as unseen."""
        return self.looked_up_share(before, ids, before * len(self.of) + ids)[0]

    def looked_up_share(self, before: np.ndarray, ids: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, and whether each pair (its key) is looked up."""
        share = self.unseen[ids]
        at, hit = self.looked_up(key)
        share[hit] = self.logs[at[hit]]
        share -= self.whole[before * CLASSES + self.of[ids]]
        return share, hit


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token places (windows, WINDOW) of joined texts, whether each is scored there, and the text of each window."""
    step = WINDOW - OVERLAP
    per = 1 + np.maximum(0, -(-(sizes - WINDOW) // step))
    text = np.repeat(np.arange(len(sizes)), per)
    number = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    begin = (np.cumsum(sizes) - sizes)[text]
    place = number[:, None] * step + np.arange(WINDOW)
    scored = (place < sizes[text][:, None]) & ((number[:, None] == 0) | (np.arange(WINDOW) >= OVERLAP))
    return begin[:, None] + np.minimum(place, sizes[text][:, None] - 1), scored, text


def joined(ids: list[bytes], classes: Classes, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids to predict of joined texts, the read classes before them, and the texts' sizes."""
    mark = np.array([end_id], np.uint16).tobytes()
    wanted = np.frombuffer(b"".join(x + mark for x in ids), np.uint16).astype(np.int64)
    sizes = np.array([len(x) // 2 + 1 for x in ids], np.int64)
    context = np.empty(len(wanted), np.int64)
    context[1:] = classes.read[wanted[:-1]]
    context[np.cumsum(sizes) - sizes] = classes.read[end_id]
    return wanted, context, sizes


def rounds_of(tokens: int) -> int:
    """Rounds one after the other; each is dealt over all tasks."""
    return ROUNDS + MORE_ROUNDS * max(0, math.ceil(math.log2(tokens / ROUND_TOKENS)))


def steps_of(sizes: list[int]):
    """Ranges of texts of about ``STEP_TOKENS`` tokens; a longer text is a range of its own."""
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if i > at and held + n > STEP_TOKENS:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(sizes):
        yield at, len(sizes)


def other_pairs(classes: Classes, key: np.ndarray, sizes: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of joined texts that were not looked up: text, key, times."""
    rest = np.flatnonzero(~hit)
    both, times = np.unique(np.repeat(np.arange(len(sizes)), sizes)[rest] << 32 | key[rest], return_counts=True)
    return both >> 32, both & 0xFFFFFFFF, times


def scored_pairs(model: Attention, classes: Classes, ids: list[bytes], end_id: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Natural log probability of each text, without what its other pairs add, and those pairs."""
    wanted, context, sizes = joined(ids, classes, end_id)
    place, scored, _ = windows(sizes)
    key = context * len(classes.of) + wanted
    goal, (value, hit) = classes.of[wanted], classes.looked_up_share(context, wanted, key)
    order = np.argsort(~scored[:, 0], kind="stable")  # first windows predict at all their positions
    for at in range(0, len(place), BATCH):
        some = order[at : at + BATCH]
        rows, mask = place[some], scored[some]
        tokens = rows[mask]  # each token is scored in one window
        value[tokens] += model.log_probs(model.hidden(context[rows], mask), goal[tokens])
    return np.add.reduceat(value, np.cumsum(sizes) - sizes), other_pairs(classes, key, sizes, hit)


def score(model: Attention, classes: Classes, ids: list[bytes], end_id: int) -> np.ndarray:
    """Natural log probability of each text, without what its other pairs add."""
    return scored_pairs(model, classes, ids, end_id)[0]


def lowered(text: str | None) -> str:
    """A to Z in lower case, all else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") if text else ""  # of bytes, lower() changes A to Z only


_ENCODERS: dict[int, Encoder] = {}
_HASHES: dict[bytes, int] = {}


def _forget() -> None:
    _ENCODERS.clear()
    _HASHES.clear()


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)


def tokens_of(text: str | None) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes.lower() changes A to Z only
    words.append(END)
    return words


def _encoded(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``uid, doc_id, held_out, ids`` (16-bit) of all texts, as a written table."""
    vocab = rows.sparkSession.sparkContext.broadcast(vocabulary)  # a fixed file of about 2 MB

    def run(batches):
        claim("attention", _forget)
        key = hash(vocab.value)
        if key not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[key] = Encoder(Bpe(vocab.value))
        encoder = _ENCODERS[key]
        for batch in batches:
            for a, b in chunks([t or "" for t in batch["text"]]):
                ids = encoder.encode([lowered(t) for t in batch["text"][a:b]])
                yield {"uid": batch["uid"][a:b], "held_out": batch["held_out"][a:b], "ids": [np.frombuffer(x, "<u4").astype(np.uint16).tobytes() for x in ids]}

    return saved(map_rows(rows.select("uid", "held_out", "text"), run, "uid long, held_out boolean, ids binary"), "ids")


def _fit(encoded: DataFrame, bpe: Bpe, end_id: int) -> tuple[Attention, Classes, DataFrame | None]:
    """Weights, classes, and what each other pair adds to a score (``key, gain``); ``trained`` of the model counts its windows."""
    train = encoded.where("NOT held_out").select("uid", "ids")
    size = max(bpe.tokens) + 1

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch["ids"]:
                total += np.bincount(np.frombuffer(x, np.uint16), minlength=size) if len(x) > 100_000 else 0
            total += np.bincount(np.frombuffer(b"".join(x for x in batch["ids"] if len(x) <= 100_000), np.uint16), minlength=size)
            total[end_id] += len(batch["ids"])
        some = np.flatnonzero(total)
        yield {"id": some, "n": total[some]}

    counts = np.zeros(size, np.int64)
    for r in map_rows(train.select("ids"), count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most one row an id
        counts[r["id"]] = r["n"]
    spaced = np.array([int(bpe.tokens.get(i, b"")[:1] in (b" ", b"\n")) for i in range(size)])
    classes, model = Classes(counts, spaced), Attention()
    model.trained = 0
    if not counts.any():
        return model, classes, None
    tokens = int(counts.sum())

    def pairs(batches):
        found: dict[int, int] = {}

        def out():
            key = np.fromiter(found, np.int64, len(found))
            return {"key": key, "cell": key // size * CLASSES + classes.of[key % size], "n": list(found.values())}

        for batch in batches:
            for a, b in steps_of([len(x) // 2 + 1 for x in batch["ids"]]):
                wanted, context, _ = joined(batch["ids"][a:b], classes, end_id)
                for k, n in zip(*(x.tolist() for x in np.unique(context * size + wanted, return_counts=True)), strict=True):
                    found[k] = found.get(k, 0) + n
                if len(found) > KEPT_PAIRS:
                    yield out()
                    found = {}
        yield out()

    plain = classes.plain

    def gains(batches):
        for batch in batches:
            key = np.array(batch["key"], np.int64)
            yield {"key": key, "gain": np.log1p(np.array(batch["n"]) / (PLAIN * plain[key % size]))}

    after = map_rows(train.select("ids"), pairs, "key long, cell int, n long").groupBy("key", "cell").agg(F.sum("n").alias("n"))
    after = saved(after, "pairs")
    often = F.col("n") >= max(2.0, PAIR_SHARE * tokens)
    cells = after.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most read classes x classes
    known = after.where(often).select("key", "n").toArrow()  # at most 1 / PAIR_SHARE
    classes.after(*(x[c].to_numpy() for x, c in ((known, "key"), (known, "n"), (cells, "cell"), (cells, "n"))))
    rare = map_rows(after.where(~often).select("key", "n"), gains, "key long, gain double")

    placed = encoded.sparkSession.sparkContext.broadcast(classes)
    share = min(1.0, FIT_WINDOWS * len(RATES) * (WINDOW - OVERLAP) / tokens)

    def drawn(batches):
        """Windows whose hash is below the share; no text is left out."""
        classes = placed.value
        for batch in batches:
            for a, b in steps_of([len(x) // 2 + 1 for x in batch["ids"]]):
                wanted, context, sizes = joined(batch["ids"][a:b], classes, end_id)
                place, scored, text = windows(sizes)
                number = np.arange(len(place)) - np.searchsorted(text, text)
                hashed = _mix(np.array(batch["uid"][a:b], np.int64).astype(np.uint64)[text] + number.astype(np.uint64) * GOLD)
                keep = np.flatnonzero((hashed >> U(11)) < share * 2.0**53)
                yield {"h": hashed[keep].astype(np.int64), "context": [x.tobytes() for x in context[place[keep]]], "wanted": [x.tobytes() for x in classes.of[wanted[place[keep]]]], "scored": [x.tobytes() for x in scored[keep]]}

    some = map_rows(train, drawn, "h long, context binary, wanted binary, scored binary").collect()  # about FIT_WINDOWS a rate, from all texts
    some.sort(key=tuple)
    table = lambda i, kind: np.frombuffer(b"".join(r[i] for r in some), kind).reshape(-1, WINDOW)
    start = table(1, np.int64), table(2, np.int64), table(3, bool)
    model.w["bias"] = np.log(np.bincount(classes.of, counts, CLASSES) + 1.0).astype(np.float32)
    for k, rate in enumerate(RATES):  # each rate gets a share of the windows, or all of a small table
        part = slice(k, None, len(RATES)) if len(some) > FIT_WINDOWS else slice(None)
        model.train(*(x[part] for x in start), rate, 1)
    names = list(model.w)

    def refine(batches):
        classes = placed.value
        own, moments, n = Attention({k: v.copy() for k, v in shared.value.items()}), None, 0
        for batch in batches:
            for a, b in steps_of([len(x) // 2 + 1 for x in batch["ids"]]):
                wanted, context, sizes = joined(batch["ids"][a:b], classes, end_id)
                place, scored, _ = windows(sizes)
                moments = own.train(context[place], classes.of[wanted[place]], scored, REFINE_RATE, 1, moments=moments)
                n += len(place)
        if n:
            yield {"n": [n], "w": [np.concatenate([own.w[k].ravel() for k in names]).tobytes()]}

    def average(batches):
        total, n = 0.0, 0
        for batch in batches:
            for w, k in zip(batch["w"], batch["n"], strict=True):
                total, n = total + np.frombuffer(w, np.float32).astype(np.float64) * k, n + k
        if n:
            yield {"n": [n], "w": [(total / n).astype(np.float32).tobytes()]}

    rounds = rounds_of(tokens)
    for k in range(rounds):
        shared = encoded.sparkSession.sparkContext.broadcast(model.w)
        some = train.where(F.pmod(F.xxhash64("uid", F.lit(SEED)), F.lit(rounds)) == k).select("ids")
        refined = map_rows(some, refine, "n long, w binary").repartition(GROUPS)
        found = map_rows(refined, average, "n long, w binary").collect()  # one set of weights a group
        if not found:
            continue
        flat = np.average([np.frombuffer(r.w, np.float32) for r in found], axis=0, weights=[r.n for r in found])
        at, weights = 0, {}
        for name in names:
            weights[name] = flat[at : at + model.w[name].size].reshape(model.w[name].shape).astype(np.float32)
            at += model.w[name].size
        model.w = weights
        model.trained += sum(r.n for r in found)
    return model, classes, rare


def base_scores(rows: DataFrame) -> DataFrame:
    """``uid, n_tokens, n_known, train_tokens, base_score`` of a smoothed word unigram."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                seen.update(tokens_of(t))
            if len(seen) > KEPT_WORDS:
                yield {"word": list(seen), "n": list(seen.values())}
                seen.clear()
        yield {"word": list(seen), "n": list(seen.values())}

    counts = map_rows(rows.where("NOT held_out").select("text"), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = saved(counts, "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = {bytes(r.word): r.n for r in counts.where(F.col("n") >= max(2.0, FREQUENT * total)).collect()}  # at most 1 / FREQUENT
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    below = math.log10(total + 0.1 * (distinct + 1)) if total else 0.0
    unseen = math.log10(0.1)

    def known(batches):
        """The part of frequent words of each text, and a row for each other word of it (hash, times)."""
        logs = {w: math.log10(n + 0.1) for w, n in shared.value.items()}
        for batch in batches:
            for a, b in chunks([t or "" for t in batch["text"]]):
                uid, size, hits, value, rest = batch["uid"][a:b], [], [], [], ([], [], [])
                for u, t in zip(uid, batch["text"][a:b], strict=True):
                    words = tokens_of(t)
                    found = [x for x in map(logs.get, words) if x is not None]
                    size.append(len(words))
                    hits.append(len(found))
                    value.append(math.fsum(found))
                    if len(found) < len(words):
                        other = Counter([w for w in words if w not in logs])
                        if len(_HASHES) > KEPT_WORDS:
                            _HASHES.clear()
                        for w, k in other.items():
                            if (h := _HASHES.get(w)) is None:
                                h = _HASHES[w] = word_hash(w)
                            rest[0].append(u)
                            rest[1].append(h)
                            rest[2].append(k)
                pad, tail = [None] * len(rest[0]), [None] * len(uid)
                yield {"uid": uid + rest[0], "n": size + pad, "hits": hits + pad, "value": value + pad, "h": tail + rest[1], "k": tail + rest[2]}

    def hashed(batches):
        for batch in batches:
            yield {"h": [word_hash(w) for w in batch["word"]], "c": batch["n"]}

    found = saved(map_rows(rows.select("uid", "text"), known, "uid long, n long, hits long, value double, h long, k long"), "known")
    rare = map_rows(counts.where(F.col("n") < max(2.0, FREQUENT * total)), hashed, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    other = found.where("h IS NOT NULL").select("uid", "h", "k").join(rare, "h", "left")
    other = other.groupBy("uid").agg(F.sum(F.col("k") * F.coalesce(F.log10(F.col("c") + 0.1), F.lit(unseen))).alias("other"), F.sum(F.when(F.col("c").isNotNull(), F.col("k"))).alias("more"))
    # rows that repeat have one uid, so the sums of their other words hold each as often as the row
    out = found.where("h IS NULL").groupBy("uid").agg(F.max("n").alias("n"), F.max("hits").alias("hits"), F.max("value").alias("value"), F.count(F.lit(1)).alias("times"))
    out = out.join(other, "uid", "left")
    base = F.col("value") + F.coalesce(F.col("other") / F.col("times"), F.lit(0.0)) - F.col("n") * F.lit(below)
    return out.select("uid", F.col("n").alias("n_tokens"), (F.col("hits") + F.coalesce(F.expr("more DIV times"), F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"))


def score_texts(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, n_subwords, score`` (log10)."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        spec = file.read()
    bpe = Bpe(spec)
    end_id = next(iter(bpe.special.values()))
    # rows that repeat both doc_id and text share a uid and get the same scores
    rows = docs.select("doc_id", F.col(text).alias("text"), held_out().alias("held_out")).withColumn("uid", F.xxhash64("doc_id", text))
    encoded = _encoded(rows, spec)
    model, classes, rare = _fit(encoded, bpe, end_id)
    shared = docs.sparkSession.sparkContext.broadcast((model.w, classes))

    def run(batches):
        """The score of each text, and a row for each other pair of it (key, times)."""
        weights, classes = shared.value
        model = Attention(weights)
        for batch in batches:
            sizes = [len(x) // 2 + 1 for x in batch["ids"]]
            for a, b in steps_of(sizes):
                uid, (values, others) = batch["uid"][a:b], scored_pairs(model, classes, batch["ids"][a:b], end_id)
                text, key, times = (x.tolist() for x in others)
                pad, tail = [None] * len(key), [None] * len(uid)
                yield {"uid": uid + [uid[i] for i in text], "n_subwords": sizes[a:b] + pad, "value": values.tolist() + pad, "key": tail + key, "k": tail + times}

    found = map_rows(encoded.select("uid", "ids"), run, "uid long, n_subwords long, value double, key long, k long")
    if rare is None:
        scored = found.where("key IS NULL").groupBy("uid").agg(F.max("n_subwords").alias("n_subwords"), F.max("value").alias("value"))
        log = F.col("value")
    else:
        found = saved(found, "scored")
        other = found.where("key IS NOT NULL").select("uid", "key", "k").join(rare, "key").groupBy("uid").agg(F.sum(F.col("k") * F.col("gain")).alias("other"))
        # rows that repeat have one uid, so the sum of their other pairs holds each as often as the row
        scored = found.where("key IS NULL").groupBy("uid").agg(F.max("n_subwords").alias("n_subwords"), F.max("value").alias("value"), F.count(F.lit(1)).alias("times"))
        scored = scored.join(other, "uid", "left")
        log = F.col("value") + F.coalesce(F.col("other") / F.col("times"), F.lit(0.0))
    scored = scored.select("uid", "n_subwords", (log / F.lit(math.log(10))).alias("score"))
    return rows.select("doc_id", "held_out", "uid").join(base_scores(rows), "uid").join(scored, "uid").drop("uid")
