"""Byte-level BPE encoding and decoding, with tree concatenation for long unsplit text.

Where white space follows something else the pre-tokenizer always breaks, so the pieces between
such places are encoded on their own and give the ids of the whole text. A piece that is still
long (no white space for thousands of characters) is cut into pre-tokens; a pre-token that is
itself long is halved down to short leaves, the leaves are encoded in one parallel batch, and
the halves are joined pairwise: a window of a few tokens either side of the join is encoded
anew, growing until its first token is the left side's own and its last token the right side's
own. From then on each adjacent pair of ids comes from one correct encoding, which makes the
joined ids exactly the encoding of the whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from clickwell.llm import common, encoding

LONG = 2_048
FIRST_WINDOW = 4

PIECES = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")

_words: dict[str, encoding.Words] = {}
_vocab: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def vocab_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, with the start and length of each id."""
    if path not in _vocab:
        model = encoding.tokenizer(path)
        names, special = encoding.alphabet(), model.get_added_tokens_decoder()
        size = model.get_vocab_size(with_added_tokens=True)
        tokens = [
            special[i].content.encode() if i in special
            else bytes(names[c] for c in model.id_to_token(i)) for i in range(size)]
        lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        _vocab[path] = (np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths)
    return _vocab[path]


def joined(model: Tokenizer, left: tuple[str, list], right: tuple[str, list]) -> tuple[str, list]:
    """The tokens of two neighbouring texts as those of their concatenation. A token is
    (id, start, end) within its text; both texts lie in one pre-token."""
    a, b = left[1], right[1]
    shift = len(left[0])
    text = left[0] + right[0]
    size = FIRST_WINDOW
    while True:
        i, j = max(0, len(a) - size), min(len(b), size)
        lo, hi = a[i][1], b[j - 1][2] + shift
        window = tokens_of(model, text[lo:hi])
        first = i == 0 or window[0] == (a[i][0], 0, a[i][2] - lo)
        last_own = (b[j - 1][0], b[j - 1][1] + shift - lo, hi - lo)
        last = j == len(b) or window[-1] == last_own
        if first and last:
            return text, [*a[:i], *[(t, s + lo, e + lo) for t, s, e in window], *[(t, s + shift, e + shift) for t, s, e in b[j:]]]
        size *= 2


def tokens_of(model: Tokenizer, text: str) -> list[tuple[int, int, int]]:
    return with_places(model.encode(text, add_special_tokens=False))


def with_places(found) -> list[tuple[int, int, int]]:
    return [(t, s, e) for t, (s, e) in zip(found.ids, found.offsets)]


def tree(model: Tokenizer, text: str, leaf: int = LONG) -> list[int]:
    """The ids of a long pre-token: leaves in one batch, then joins level by level.

    Windows are cut between characters. Where a token ends inside a character (bytes of one
    character in several tokens) its places cover the whole character and windows would overlap;
    such texts are encoded whole.
    """
    parts = [text[i:i + leaf] for i in range(0, len(text), leaf)]
    level = [(p, with_places(e)) for p, e in zip(parts, model.encode_batch(parts, add_special_tokens=False))]
    if any(s[2] > t[1] for _, tokens in level for s, t in zip(tokens, tokens[1:])):
        return model.encode(text, add_special_tokens=False).ids
    while len(level) > 1:
        pairs = [joined(model, level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(level) // 2 * 2:]
    return [t for t, _, _ in level[0][1]]


def encode_piece(path: str, piece: str, long: int = LONG) -> list[int]:
    """The ids of a text between two breaks."""
    if len(piece) <= long:
        return encoding.ids_by(path)(piece)
    model = encoding.tokenizer(path)
    ids: list[int] = []
    for part in special_parts(model, piece):
        if model.token_to_id(part) is not None and part in special_names(model):
            ids.append(model.token_to_id(part))
            continue
        for _, (start, end) in model.pre_tokenizer.pre_tokenize_str(part):
            token = part[start:end]
            ids += tree(model, token, long) if len(token) > long else model.encode(token, add_special_tokens=False).ids
    return ids


def special_names(model: Tokenizer) -> list[str]:
    return [t.content for t in model.get_added_tokens_decoder().values()]


def special_parts(model: Tokenizer, text: str) -> list[str]:
    """The text cut around special tokens, which stay parts of their own."""
    names = special_names(model)
    if not names:
        return [text]
    return [p for p in re.split("(" + "|".join(map(re.escape, names)) + ")", text) if p]


def encode_text(path: str, text: str) -> bytes:
    """The ids of a whole text as 32-bit numbers."""
    words = _words.setdefault(path, encoding.Words(lambda piece: encode_piece(path, piece)))
    if encoding.RARE_SPACE.search(text):
        return np.array(encode_piece(path, text), dtype="<u4").tobytes()
    return b"".join([words[piece] for piece in PIECES.findall(text)])


def lists_of(parts: list[bytes]) -> pa.Array:
    """Ids of several texts as an Arrow list array."""
    ends = np.cumsum([0] + [len(p) // 4 for p in parts], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def encode(text: Column, path: str) -> Column:
    """Token ids (array of int) of a text column; null stays null."""
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        found = lists_of([encode_text(path, t.as_py() or "") for t in texts])
        if not texts.null_count:
            return found
        return pa.ListArray.from_arrays(found.offsets, found.values, mask=texts.is_null())

    return ids(text)


def decode_batch(path: str, ids: pa.ListArray) -> list[str | None]:
    flat, starts, lengths = vocab_bytes(path)
    out: list[str | None] = []
    for row in ids:
        if not row.is_valid:
            out.append(None)
            continue
        own = row.values.to_numpy(zero_copy_only=False)
        size = lengths[own]
        at = np.repeat(starts[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out.append(flat[at].tobytes().decode("utf-8", "replace"))
    return out


def decode(ids: Column, path: str) -> Column:
    """The text of an id column; bytes that are no UTF-8 become U+FFFD; null stays null."""
    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        return pa.array(decode_batch(path, lists), pa.string())

    return texts(ids)


def roundtrip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded text of each row: one row per row, repeated rows included.

    A null text counts as empty, an empty one has no ids and decodes to the empty text. Texts of
    any length are encoded whole. Other columns are not read. An empty table gives no rows.
    """
    coded = docs.select("doc_id", encode(common.text_of(), path).alias("ids"))
    return coded.select("doc_id", "ids", decode(F.col("ids"), path).alias("decoded"))


def op7_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return roundtrip(common.table(spark, sf_dir, "documents"), path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
