"""Language-model scores: a causal self-attention model over subword ids, in numpy.

Words are cut into the subword ids of a public byte-level vocabulary (a word begins with a blank
there, so ids give the words back). The model has one layer of causal self-attention and a small
feed-forward part; it predicts the class of the next subword, and corpus counts tell the subword
within its class, given the subword before it in the word. Frequent subwords are classes of their
own, the others are clustered by what stands beside them inside words. Subwords that begin a word and
those that continue one are never of the same class, so the shares within each class, single
ones or those of pairs, sum to one, and so does the model over all next subwords. The classes, the counts of
pairs and the counts of words are gathered over all training documents. Attention weights are trained on all training texts
from end to end, each token being a target at least once: shards train in parallel, their weights
are averaged, several rounds.

Long texts are scored in overlapping windows: each window after a text's first only scores the
positions behind the overlap, so each token counts once and sees at least OVERLAP tokens. The
model's probability of a word is that of its subwords, given that a word begins, times that of a word
beginning after them: over all words it sums to one at most. A word's probability is a mixture of the attention model and the word's corpus share, the
smoothed one of the base score: unseen words are one word there, and what the model gives to the spelling of one
is at most its share of that word, so over all seen words and the unseen one it sums to one at most, and a text's score is
never below its base score by more than log10(SHARE) a token. Shares of the
most frequent words are at hand in all tasks, those of all others come by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickwell.llm import common, encoding
from clickwell.llm.toxicity import blocks

END = b"\n"  # the end of a text as a word: no word holds white space

WINDOW, OVERLAP, WIDTH, HIDDEN = 24, 6, 16, 16
STRIDE = WINDOW - OVERLAP
KNOWN_IDS = 2_048  # subwords with an embedding and a class by cluster: the most frequent ones
SINGLE, CLUSTERS, SPARE = 48, 15, 64
BEGIN_CLUSTERS = 8  # of the clusters, those of ids that begin a word
CHUNK = 65_536  # training windows a task holds at a time; a shard may have any number of them
BACKOFF = 10.0  # weight of the class's shares against counts of pairs
CLASSES = SINGLE + CLUSTERS + 2
HEAD_WORDS = 100_000  # words whose share of the corpus is sent to all tasks: a bounded table
SHARE = 0.5  # of the words' corpus shares in the mixture
ROUNDS, STEPS, EPOCHS, BATCH, RATE = 3, 200, 6, 64, 1e-2  # STEPS and EPOCHS bound repeated passes, never the first

COUNTS = "word binary, n bigint"
SCORED = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, head_log double, score double, word binary, model double"

class Ids(dict):
    """Word (UTF-8) -> its subword ids as bytes of 32-bit numbers."""

    def __init__(self, path: str):
        super().__init__()
        plain, end = encoding.ids_by(path), encoding.tokenizer(path).get_vocab_size()
        self.pieces = encoding.Words(lambda piece: plain(piece) or [end])
        self.many = encoding.many(path)
        self.end = np.array([end], dtype="<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.end if word == END else self.pieces[" " + word.decode("utf-8", "replace")]
        if len(self) >= encoding.CACHE_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def all(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; new ones are encoded together where the vocabulary has a way for that."""
        if self.many:
            distinct = set(words)
            new = [w for w in distinct if w not in self]
            if len(self) + len(new) > encoding.CACHE_WORDS:
                held = {w: self[w] for w in distinct.difference(new)}
                self.clear()
                self.update(held)
            texts = {w.decode("utf-8", "replace"): w for w in new}
            if len(texts) == len(new):
                for text, ids in self.many(list(texts)).items():
                    self[texts[text]] = ids
        return [self[w] for w in words]


_ids: dict[str, Ids] = {}


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, A-Z lower-cased, cut at blanks and the controls 9 to 13: what
    these two methods of bytes mean by letters and white space."""
    return text.lower().split()


def learned(doc_id: Column) -> Column:
    """Whether a document is learned from; null ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 != 0, F.lit(True))


def subwords(path: str) -> Ids:
    """Word -> ids, one table per process; the end of a text has the id behind the vocabulary's."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


def beginnings(path: str, size: int) -> np.ndarray:
    """Of each id whether it begins a word: those that hold the blank before it, and the end of a text."""
    out = np.zeros(size, dtype=bool)
    for piece, i in encoding.tokenizer(path).get_vocab().items():
        out[i] = piece.startswith("Ġ")
    out[-1] = True
    return out


def utf8(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all training documents, ends of texts included. Tasks count ahead in
    bounded dictionaries, so the shuffle moves a word once per task and not once per place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for t in utf8(b.column(0)):
                counts.update(words_of(t))
                counts[END] += 1
                if len(counts) > 300_000:
                    yield out()
                    counts.clear()
        yield out()

    return common.written(docs.where(learned(F.col("doc_id"))).select(common.text_of().alias("text")).mapInArrow(
        run, COUNTS).groupBy("word").agg(F.sum("n").alias("n")), "words")


def pair_counts(words: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(id, n) and (a, b, n): subwords and neighbours inside words over the whole corpus, made
    from its distinct words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = subwords(path)
        for b in batches:
            ids = table.all(b.column(0).to_pylist())
            size = [len(i) // 4 for i in ids]
            flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
            n = np.repeat(b.column(1).to_numpy(), size)
            first = np.zeros(len(flat), bool)
            first[np.cumsum([0, *size[:-1]])[:len(size)]] = True
            before = np.where(first, -1, np.append(-1, flat[:-1])) if len(flat) else flat
            key, where = np.unique((before + 1) << 20 | flat, return_inverse=True)
            total = np.bincount(where, n, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array((key >> 20) - 1), pa.array(key & ((1 << 20) - 1)), pa.array(total)], ["a", "b", "n"])

    pairs = common.written(words.mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(
        F.sum("n").alias("n")), "pairs")
    return pairs.groupBy(F.col("b").alias("id")).agg(F.sum("n").alias("n")), pairs.where("a >= 0")


def clusters(features: np.ndarray, k: int) -> np.ndarray:
    """k-means on rows of unit length."""
    rng = np.random.default_rng(5)
    centres = features[rng.choice(len(features), min(k, len(features)), replace=False)]
    label = np.zeros(len(features), dtype=np.int64)
    for _ in range(12):
        label = (features @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            own = features[label == c]
            if len(own):
                mean = own.sum(axis=0)
                centres[c] = mean / max(1e-9, np.linalg.norm(mean))
    return label


class Vocabulary:
    """Input number, class and log share within its class of each subword id."""

    def __init__(self, size: int, ids: np.ndarray, counts: np.ndarray, pairs: np.ndarray, begins: np.ndarray | None = None):
        """`begins` tells of each id whether it begins a word."""
        begins = np.ones(size, dtype=bool) if begins is None else begins
        order = np.lexsort((ids, -counts))
        ids, counts = ids[order], counts[order].astype(np.float64)
        top = ids[:KNOWN_IDS]
        rank = np.full(size, -1, dtype=np.int64)
        rank[top] = np.arange(len(top))
        self.inputs = np.where(rank >= 0, rank, KNOWN_IDS + np.arange(size) % SPARE)
        self.classes = np.where(begins, CLASSES - 2, CLASSES - 1)
        self.classes[top[:SINGLE]] = np.arange(len(top[:SINGLE]))
        rest = top[SINGLE:]
        if len(rest):
            beside = np.zeros((len(top), 2 * len(top)), dtype=np.float32)
            a, b, n = rank[pairs[:, 0]], rank[pairs[:, 1]], np.sqrt(pairs[:, 2])
            known = (a >= 0) & (b >= 0)
            np.add.at(beside, (b[known], a[known]), n[known])
            np.add.at(beside, (a[known], len(top) + b[known]), n[known])
            beside = beside[SINGLE:]
            beside /= np.maximum(1e-9, np.linalg.norm(beside, axis=1, keepdims=True))
            for kind, at, k in ((True, SINGLE, BEGIN_CLUSTERS), (False, SINGLE + BEGIN_CLUSTERS, CLUSTERS - BEGIN_CLUSTERS)):
                own = begins[rest] == kind
                if own.any():
                    self.classes[rest[own]] = at + clusters(beside[own], k)
        each = np.full(size, 0.1)
        each[ids] += counts
        total = np.bincount(self.classes, each, minlength=CLASSES)
        self.log_share = np.log(each / total[self.classes]).astype(np.float32)
        self.log_class = np.log(total / total.sum() + 1e-9).astype(np.float32)
        self.empty = total == 0
        self.beginning = np.zeros(CLASSES, dtype=np.float32)  # 1 for classes of ids that begin a word
        self.beginning[self.classes[begins]] = 1
        # Log share of the second of two neighbours within its class, given the first.
        self.rank = rank
        seen = np.zeros((len(top), len(top)), dtype=np.float32)
        a, b = rank[pairs[:, 0]], rank[pairs[:, 1]]
        known = (a >= 0) & (b >= 0)
        np.add.at(seen, (a[known], b[known]), pairs[known, 2])
        into = np.zeros((len(top), CLASSES), dtype=np.float32)
        np.add.at(into.T, self.classes[top], seen.T)
        seen += BACKOFF * np.exp(self.log_share[top])
        seen /= into[:, self.classes[top]] + BACKOFF
        self.log_pair = np.log(seen)

    def log_within(self, ids: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Log share of each id within its class; `inner` marks ids that continue a word."""
        out = self.log_share[ids]
        at = np.flatnonzero(inner)
        a, b = self.rank[ids[at - 1]], self.rank[ids[at]]
        known = (a >= 0) & (b >= 0)
        out[at[known]] = self.log_pair[a[known], b[known]]
        return out


def start(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(3)
    draw = lambda *shape: (rng.standard_normal(shape) * shape[0] ** -0.5).astype(np.float32)
    return {
        "embed": (rng.standard_normal((KNOWN_IDS + SPARE + 1, WIDTH)) * 0.5).astype(np.float32),
        "place": (rng.standard_normal((WINDOW, WIDTH)) * 0.1).astype(np.float32),
        "qkv": draw(WIDTH, 3 * WIDTH), "mix": draw(WIDTH, WIDTH), "up": draw(WIDTH, HIDDEN),
        "up0": np.zeros(HIDDEN, np.float32), "down": draw(HIDDEN, WIDTH),
        "out": draw(WIDTH, CLASSES) * np.float32(0.1), "out0": vocabulary.log_class.copy()}


MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, dtype=np.float32), 1)
BEFORE = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))


def attend(p: dict, tokens: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden states of windows (n x WINDOW input numbers), each place seeing itself and what is
    before; and what the gradient needs."""
    x = p["embed"][tokens] + p["place"]
    q, k, v = np.split(x @ p["qkv"], 3, axis=2)
    a = q @ k.transpose(0, 2, 1)
    a *= np.float32(WIDTH**-0.5)
    a += MASK
    np.minimum(a, 30, out=a)
    np.exp(a, out=a)
    a /= a.sum(axis=2, keepdims=True)
    o = a @ v
    h = x + o @ p["mix"]
    u = np.maximum(h @ p["up"] + p["up0"], 0)
    return h + u @ p["down"], (tokens, x, q, k, v, a, o, h, u)


def log_classes(p: dict, g: np.ndarray) -> np.ndarray:
    z = g @ p["out"]
    z += p["out0"]
    z -= z.max(axis=-1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=-1, keepdims=True))
    return z


def prepared(p: dict, v: Vocabulary | None = None) -> dict[str, np.ndarray]:
    """The weights as scoring wants them: the scale of attention within those of the queries, no
    mass on classes without an id, and which classes begin a word."""
    qkv = p["qkv"].copy()
    qkv[:, :WIDTH] *= np.float32(WIDTH**-0.5)
    ones = np.ones(CLASSES, dtype=np.float32)
    out0 = p["out0"] if v is None else np.where(v.empty, np.float32(-1e4), p["out0"])
    return p | {"qkv": qkv, "out0": out0, "before": BEFORE,
                "ones": ones, "sums": np.stack([ones, ones if v is None else v.beginning], axis=1)}


def log_target(p: dict, tokens: np.ndarray, live: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the target class, and of any that begins a word, at each live place of
    windows: what attend() and log_classes() give, in fewer passes. Exponents are not shifted, so weights beyond a float's
    range give no finite number; such a block goes the longer way."""
    n, at = len(tokens), np.flatnonzero(live)
    x = p["embed"].take(tokens.ravel(), axis=0)
    x.reshape(n, WINDOW, WIDTH)[...] += p["place"]
    qkv = (x @ p["qkv"]).reshape(n, WINDOW, 3 * WIDTH)
    a = qkv[:, :, :WIDTH] @ qkv[:, :, WIDTH:2 * WIDTH].transpose(0, 2, 1)
    np.exp(a, out=a)
    a *= p["before"]
    o = (a @ qkv[:, :, 2 * WIDTH:]).reshape(-1, WIDTH).take(at, axis=0)
    o /= (a.reshape(-1, WINDOW) @ p["ones"][:WINDOW]).take(at)[:, None]
    h = o @ p["mix"]
    h += x.take(at, axis=0)
    u = h @ p["up"]
    u += p["up0"]
    np.maximum(u, 0, out=u)
    h += u @ p["down"]
    z = h @ p["out"]
    z += p["out0"]
    own = z[np.arange(len(z)), target]
    np.exp(z, out=z)
    whole, begin = np.log(z @ p["sums"]).T
    return own - whole, begin - whole


def gradient(p: dict, tokens: np.ndarray, target: np.ndarray, live: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log probability of the target classes at the live places."""
    n, at = len(tokens), np.flatnonzero(live)
    many = max(1, len(at))
    # The scale of attention, a power of two, stands within the weights of the queries.
    scale = p["qkv"].dtype.type(WIDTH**-0.5)
    weights = p["qkv"].copy()
    weights[:, :WIDTH] *= scale
    x = p["embed"].take(tokens.ravel(), axis=0)
    x.reshape(n, WINDOW, WIDTH)[...] += p["place"]
    qkv = (x @ weights).reshape(n, WINDOW, 3 * WIDTH)
    q, k, v = qkv[:, :, :WIDTH], qkv[:, :, WIDTH:2 * WIDTH], qkv[:, :, 2 * WIDTH:]
    a = q @ k.transpose(0, 2, 1)
    np.minimum(a, 30, out=a)
    np.exp(a, out=a)
    a *= BEFORE
    a /= a.sum(axis=2, keepdims=True)
    o = (a @ v).reshape(-1, WIDTH)
    h = o @ p["mix"]
    h += x
    u = h @ p["up"]
    u += p["up0"]
    np.maximum(u, 0, out=u)
    g = (u @ p["down"]).take(at, axis=0)
    g += h.take(at, axis=0)
    dz = log_classes(p, g)
    np.exp(dz, out=dz)
    dz[np.arange(len(at)), target.ravel().take(at)] -= 1
    dz /= many
    out = {"out": g.T @ dz, "out0": dz.sum(axis=0)}
    dh = np.zeros_like(x)
    dh[at] = dz @ p["out"].T
    du = dh @ p["down"].T
    du *= u > 0
    out |= {"down": u.T @ dh, "up": h.T @ du, "up0": du.sum(axis=0)}
    dh += du @ p["up"].T
    out["mix"] = o.T @ dh
    do = (dh @ p["mix"].T).reshape(n, WINDOW, WIDTH)
    ds = do @ v.transpose(0, 2, 1)
    ds -= (ds * a).sum(axis=2, keepdims=True)
    ds *= a
    dqkv = np.empty_like(qkv)
    np.matmul(ds, k, out=dqkv[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, WIDTH:2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), do, out=dqkv[:, :, 2 * WIDTH:])
    dqkv = dqkv.reshape(-1, 3 * WIDTH)
    out["qkv"] = x.T @ dqkv
    out["qkv"][:, :WIDTH] *= scale
    dh += dqkv @ weights.T
    out["place"] = dh.reshape(n, WINDOW, WIDTH).sum(axis=0)
    # Numbers one by one: adding to whole rows is many times slower.
    flat = np.zeros(p["embed"].size, dh.dtype)
    np.add.at(flat, (tokens.reshape(-1, 1).astype(np.intp) * WIDTH + np.arange(WIDTH)).ravel(), dh.ravel())
    out["embed"] = flat.reshape(p["embed"].shape)
    return out


def picks(n: int, seed: int) -> Iterator[np.ndarray]:
    """Batches of the numbers below n: all of them once, and again while STEPS and EPOCHS allow."""
    rng = np.random.default_rng(seed)
    steps = max(-(-n // BATCH), min(STEPS, 1 + EPOCHS * n // BATCH))
    order = np.concatenate([rng.permutation(n) for _ in range(-(-steps * BATCH // n))])
    return iter(np.split(order[:steps * BATCH], range(BATCH, steps * BATCH, BATCH)))


def fit(p: dict, tokens: np.ndarray, target: np.ndarray, seed: int) -> dict:
    """Adam over all of the windows in random batches; -1 marks places without a target. All weights
    are parts of one row of numbers, so that a step takes few passes."""
    names = sorted(p)
    flat = np.concatenate([p[name].ravel() for name in names])
    parts = np.split(flat, np.cumsum([p[name].size for name in names])[:-1])
    p = {name: part.reshape(p[name].shape) for name, part in zip(names, parts)}
    m, s, grad, change = (np.zeros_like(flat) for _ in range(4))
    batches = list(picks(len(tokens), seed))
    for step, pick in enumerate(batches, 1):
        want = target[pick]
        grads = gradient(p, tokens[pick], want, want >= 0)
        np.concatenate([grads[name].ravel() for name in names], out=grad)
        rate = RATE * min(1, 4 * (1 - step / (len(batches) + 1)))
        np.subtract(grad, m, out=change)
        change *= 0.1
        m += change
        grad *= grad
        grad -= s
        grad *= 0.01
        s += grad
        np.divide(s, 1 - 0.99**step, out=grad)
        np.sqrt(grad, out=grad)
        grad += 1e-6
        np.divide(m, 1 - 0.9**step, out=change)
        change *= rate
        change /= grad
        flat -= change
    return p


def windows_of(ids: np.ndarray, starts: list[int], begin: int) -> np.ndarray:
    """Windows of a text's inputs from the given places: the input at a place is the token before
    it, `begin` at the first; padded with it at the end."""
    padded = np.concatenate([[begin], ids, np.full(WINDOW, begin)])
    return padded[np.asarray(starts)[:, None] + np.arange(WINDOW)]


def encoded(table: Ids, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, ends included; how many each text has; all ids, how many each word has,
    and where each text's ids end."""
    words = [words_of(t) for t in texts]
    for own in words:
        own.append(END)
    flat = [w for own in words for w in own]
    each = np.array([len(own) for own in words])
    parts = table.all(flat)
    length = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    ids = np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int64)
    return flat, each, ids, length, np.cumsum(np.add.reduceat(length, np.cumsum(each) - each))


def laid_out(inputs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of texts with so many ids each, one text after another: input numbers, and which
    places are live. Each id is at one live place, in order."""
    begin = KNOWN_IDS + SPARE
    many = 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    # Places of all windows among the ids; the input at a place is the token before it.
    text = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    within = (nth * STRIDE)[:, None] + np.arange(WINDOW)
    live = within < sizes[text][:, None]
    live[nth > 0, :OVERLAP] = False
    before = (np.cumsum(sizes) - sizes)[text][:, None] + within - 1
    tokens = np.where((within > 0) & (within <= sizes[text][:, None]), inputs[np.clip(before, 0, len(inputs) - 1)], begin)
    return tokens, live


def training_windows(v: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input numbers and target classes of windows over whole texts; each id is a target once."""
    tokens, live = laid_out(v.inputs[ids], np.diff(ends, prepend=0))
    target = np.full(tokens.shape, -1, dtype=np.int32)
    target[live] = v.classes[ids]
    return tokens.astype(np.int32), target


def chunks(windows: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows again, CHUNK at a time."""
    held, n = [], 0
    for tokens, target in windows:
        for i in range(0, len(tokens), CHUNK):
            held.append((tokens[i:i + CHUNK], target[i:i + CHUNK]))
            n += len(held[-1][0])
            while n >= CHUNK:
                whole = [np.concatenate(side) for side in zip(*held)]
                yield whole[0][:CHUNK], whole[1][:CHUNK]
                held, n = [(whole[0][CHUNK:], whole[1][CHUNK:])], n - CHUNK
    if n:
        tokens, target = (np.concatenate(side) for side in zip(*held))
        yield tokens, target


def train(docs: DataFrame, vocabulary: Vocabulary, path: str, n_ids: int) -> dict[str, np.ndarray]:
    """The attention weights, averaged over all shards after each of ROUNDS rounds.

    A shard is a read split of the documents, so shards grow in number with the corpus. It trains
    on all windows of its texts, CHUNK after CHUNK, with as many steps as they fill. The rounds
    deal the documents among them, so that each is trained on in one; a corpus of few ids
    (`n_ids`) is trained on whole in every round.
    """
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast(vocabulary)
    seed = F.pmod(F.xxhash64("doc_id", F.length(common.text_of())), F.lit(ROUNDS))
    learnt = docs.where(learned(F.col("doc_id")))
    few = n_ids <= ROUNDS * STEPS * BATCH * STRIDE
    p = start(vocabulary)
    for round_ in range(ROUNDS):
        now = sc.broadcast(p)

        def shard(batches: Iterator[pa.RecordBatch], now=now, round_=round_) -> Iterator[pa.RecordBatch]:
            table, v, fitted, n = subwords(path), sent.value, now.value, 0

            def windows() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for b in batches:
                    for texts in blocks(b.column(0).cast(pa.binary()), 400_000):
                        _, _, ids, _, ends = encoded(table, texts)
                        yield training_windows(v, ids, ends)

            for tokens, target in chunks(windows()):
                fitted = fit(fitted, tokens, target, round_ + n)
                n += len(tokens)
            if not n:
                return
            flat = np.concatenate([fitted[name].ravel() for name in sorted(fitted)]).astype(np.float64) * n
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat),
                                              pa.array(np.full(len(flat), n))], ["place", "value", "n"])

        # The average is taken in Spark; the driver gets one set of weights.
        dealt = learnt if few else learnt.where(seed == round_)
        mean = dealt.select(common.text_of().alias("text")).mapInArrow(shard, "place bigint, value double, n bigint").groupBy(
            "place").agg((F.sum("value") / F.sum("n")).alias("value")).toArrow()
        if not mean.num_rows:
            continue
        flat = mean["value"].to_numpy()[np.argsort(mean["place"].to_numpy())].astype(np.float32)
        at = 0
        for name in sorted(p):
            p[name] = flat[at:at + p[name].size].reshape(p[name].shape)
            at += p[name].size
    return p


def log_tokens(p: dict, v: Vocabulary, texts: list[np.ndarray], inner: np.ndarray) -> np.ndarray:
    """Log probabilities of all ids of all texts, one after another."""
    return log_places(p, v, texts, inner)[0]


def log_places(p: dict, v: Vocabulary, texts: list[np.ndarray], inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of all ids of all texts, one after another, by prepared() weights, and at each
    id's place that of a word beginning there; `inner` marks the ids that continue a word. Windows of
    several texts go through the model together."""
    ids = np.concatenate(texts)
    tokens, live = laid_out(v.inputs[ids], np.array([len(own) for own in texts]))
    want = v.classes[ids]
    out, begin, at = np.empty(len(ids), dtype=np.float32), np.empty(len(ids), dtype=np.float32), 0
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        for i in range(0, len(tokens), 256):
            part, fresh = tokens[i:i + 256], live[i:i + 256]
            target = want[at:at + int(fresh.sum())]
            found, starts = log_target(p, part, fresh, target)
            if not (np.isfinite(found).all() and np.isfinite(starts).all()):
                plain = p | {"qkv": p["qkv"] * np.repeat(np.float32([WIDTH**0.5, 1, 1]), WIDTH)}
                logs = log_classes(plain, attend(plain, part)[0][fresh])
                found = logs[np.arange(len(target)), target]
                starts = np.log(np.maximum(np.exp(logs) @ p["sums"][:, 1], 1e-30))
            out[at:at + len(found)], begin[at:at + len(found)] = found, starts
            at += len(found)
    return out + v.log_within(ids, inner), begin


def log_words(logs: np.ndarray, begin: np.ndarray, begins: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Log probability of each word: of its ids, given that a word begins, and of a word beginning
    behind them. `begins` are the places of words' first ids; `last` marks ends of texts, behind which nothing is."""
    at = begin[begins].astype(np.float64)
    return np.add.reduceat(logs.astype(np.float64), begins) - at + np.where(last, 0.0, np.append(at[1:], 0.0))


class Frequent(dict):
    """Word -> its number among the frequent words, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def score(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score.

    Documents whose id's crc32 leaves 0 by 10 are held out, all others are learned from (a null id
    too). Null texts are empty: an end alone. Whole texts count, of any length; repeated rows count
    as often as they stand. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    counts = count_words(docs)
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    single, pairs = pair_counts(counts, path)
    # Bounded by the vocabulary: its ids, and pairs of the KNOWN_IDS most frequent ones.
    ids = single.toArrow()
    id_, n_ = ids["id"].to_numpy(), ids["n"].to_numpy()
    top = spark.createDataFrame(single.orderBy(F.desc("n"), "id").limit(KNOWN_IDS).select("id").toArrow())
    beside = pairs.join(top.select(F.col("id").alias("a")), "a", "left_semi").join(
        top.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b", "n").toArrow()
    size = encoding.tokenizer(path).get_vocab_size() + 1
    vocabulary = Vocabulary(size, id_, n_, np.stack([beside[c].to_numpy() for c in ("a", "b", "n")], axis=1), beginnings(path, size))
    weights = train(docs, vocabulary, path, int(n_.sum()))
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).toArrow()
    log_of = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    frequent = {w: i for i, w in enumerate(head["word"].to_pylist())}
    # The last place is that of all other words.
    base_log = np.array([*map(log_of, head["n"].to_pylist()), 0.0])
    spread = total + 0.1 * (distinct + 1)
    direct = np.append((head["n"].to_numpy() + 0.1) * (SHARE / spread), 0.0)
    sent = sc.broadcast((prepared(weights, vocabulary), vocabulary, frequent, base_log, direct))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, v, frequent, base_log, direct = sent.value
        known, table = Frequent(frequent), subwords(path)
        names = [f.split()[0] for f in SCORED.split(", ")]
        for b in batches:
            at = 0
            for texts in blocks(b.column(3).cast(pa.binary()), 400_000):
                flat, each, ids, length, ends = encoded(table, texts)
                first = np.cumsum(each) - each
                begins = np.cumsum(length) - length
                inner = np.ones(len(ids), dtype=bool)
                inner[begins] = False
                last = np.zeros(len(flat), dtype=bool)
                last[np.cumsum(each) - 1] = True
                by_word = log_words(*log_places(p, v, np.split(ids, ends[:-1]), inner), begins, last)
                found = np.fromiter(map(known.__getitem__, flat), dtype=np.int64, count=len(flat))
                # Where the weights give no number, the corpus share alone counts.
                model = (1 - SHARE) * np.exp(np.where(np.isfinite(by_word), np.maximum(by_word, -600), -600))
                mixed = np.where(found >= 0, np.log10(direct[found] + model), 0.0)
                total_of = lambda values, first=first: pa.array(np.add.reduceat(values, first))
                rows = b.column(0).slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([
                    rows, b.column(1).slice(at, len(texts)), b.column(2).slice(at, len(texts)), pa.array(each),
                    total_of((found >= 0).astype(np.int64)), total_of(base_log[found]), total_of(mixed),
                    pa.nulls(len(texts), pa.binary()), pa.nulls(len(texts), pa.float64())], names)
                # Words that are not among the frequent ones get their counts by a join, and with
                # them their part of both scores.
                rest = np.flatnonzero(found < 0)
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([
                    rows.take(pa.array(np.repeat(np.arange(len(texts)), each)[rest])),
                    *[pa.nulls(len(rest), kind) for kind in kinds],
                    pa.array([flat[i] for i in rest.tolist()], pa.binary()), pa.array(model[rest])], names)
                at += len(texts)

    scored = common.written(docs.select(
        common.row_id().alias("row"), F.col("doc_id").cast("bigint"), (~learned(F.col("doc_id"))).alias("held_out"),
        common.text_of().alias("text")).mapInArrow(run, SCORED), "scored")
    seen = counts.select(F.col("word").alias("seen"), F.col("n").alias("c"))
    rare = scored.where("word IS NOT NULL").join(seen, F.col("word") == F.col("seen"), "left")
    rest = rare.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(spread))).alias("rest_log"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.1) * F.lit(SHARE / spread) + F.col("model"))).alias("rest_score"),
        F.count("c").alias("rest_known"))
    return scored.where("word IS NULL").join(rest, F.col("row") == F.col("of"), "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("rest_log", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", F.lit(0.0))).alias("score"))


def op2_lm(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return score(common.table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))
