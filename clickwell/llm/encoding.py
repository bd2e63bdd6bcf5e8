"""Encoding with a tokenizers file, word by word, with a bounded cache.

Texts are cut only where the library's own pre-tokenizer must break whatever stands around, so
the ids are those of the whole text. New words cost a call of the library, known ones a lookup.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

CACHE_WORDS = 200_000

# Signs that end words.
SIGNS = ".,;:!?|&$%#*)]}\""

_open: dict[str, Tokenizer] = {}
_quick: dict[str, tuple[re.Pattern, Callable[[str], list[int]]] | None] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, opened once per process."""
    if path not in _open:
        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        _open[path] = found
    return _open[path]


_held: list = []  # the word table in use


def only(table: dict) -> None:
    """Empties the word table of another step: a worker process that is used again for the next step
    of a pipeline holds the words of one step at a time."""
    if _held and _held[0] is not table:
        _held[0].forget()
    _held[:] = [table]


class Words(dict):
    """Word -> its ids as bytes of 32-bit numbers. When full, the words so far become the older
    half; of these the ones met again come back, the others are forgotten at the next change."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int = CACHE_WORDS):
        super().__init__()
        self.encode, self.limit = encode, limit
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.made(word)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.older = {}

    def made(self, word: str) -> bytes:
        """The ids of a new word. A letter or digit before signs that end the word ends its
        pre-token in any context, so the word is put together from what stands before and after."""
        core = word.rstrip(SIGNS)
        if core and core != word and core[-1].isalnum() and len(core[-1].lower()) == 1:
            return self[core] + self[word[len(core):]]
        return np.array(self.encode(word), dtype="<u4").tobytes()


# Latin letters are one pre-token whatever the version of a vocabulary's letter tables: behind a blank
# or not where the blank belongs to the word, lower-case where the vocabulary is.
WITH_BLANK = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]{1,256}")
LOWER_CASE = re.compile(r"[a-zß-öø-ÿ]{1,256}")
# The normal form and the cutting of the lower-case vocabulary.
LOWER_STEPS = ["NFC", "Replace", "Lowercase"]
LETTER_RUNS = "[\\p{L}]+"
LAST = b"\xff"  # stands in no UTF-8


def merges(path: str) -> tuple[re.Pattern, dict[bytes, int], list[int], str] | None:
    """What words are one pre-token, the ranks of the merges, the id of each rank, and the mark of a
    word's last sign. Only for plain byte-level vocabularies of two kinds, that
    have no special token of letters alone: a blank belongs to the word behind it, or the last sign
    of a word is marked by a suffix and all is lower-case. None for others."""
    file = json.loads(tokenizer(path).to_str())
    model, cut, form = file["model"], file["pre_tokenizer"] or {}, file["normalizer"]
    steps = cut.get("pretokenizers", [])
    level = steps[-1] if steps else cut
    suffix = model.get("end_of_word_suffix") or ""
    if form is None and not steps and not suffix and level.get("use_regex"):
        words = WITH_BLANK
    elif (form and [n["type"] for n in form.get("normalizers", [])] == LOWER_STEPS and suffix and len(steps) == 2
          and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
          and LETTER_RUNS in steps[0]["pattern"].get("Regex", "").split("|") and not level.get("use_regex")):
        words = LOWER_CASE
    else:
        return None
    if level.get("type") != "ByteLevel" or level.get("add_prefix_space") or model["type"] != "BPE" or any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")) or any(
            words.fullmatch(t["content"]) for t in file["added_tokens"]):
        return None
    names, vocabulary = alphabet(), model["vocab"]
    marked = [""] + ([suffix] if suffix else [])
    tokens = [c + end for end in marked for c in names]
    tokens += ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    # Merges rank as they are listed; a last sign with its mark comes before all of them.
    raw = [bytes(names[c] for c in t.removesuffix(suffix)) + (LAST if suffix and t.endswith(suffix) else b"") for t in tokens]
    if not all(t in vocabulary for t in tokens) or len(set(raw)) != len(raw):
        return None
    ranks = {t: i for i, t in enumerate(raw)} | ({} if LAST in raw else {LAST: len(raw)})
    return words, ranks, [vocabulary[t] for t in tokens], suffix


def ranked(path: str) -> tuple[re.Pattern, Callable[[str], list[int]]] | None:
    """What words are one pre-token, and their ids by ranks of the merges, which is several times
    faster than the whole library's way. None for vocabularies that merges() does not know."""
    import tiktoken

    found = merges(path)
    if found is None:
        return None
    words, ranks, ids, suffix = found
    single = tiktoken.Encoding("ranked", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
    end = LAST if suffix else b""
    return words, lambda word: [ids[r] for r in single(word.encode() + end)]


# What the byte-level vocabularies cut at, and words of signs whose kind is the same in all versions of the letter
# tables.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_SIGNS = re.compile(r"[!-~À-ÖØ-öø-ɏ]{1,256}")


def many(path: str) -> Callable[[list[str]], dict[str, bytes]] | None:
    """Words -> the ids of each behind a blank, as bytes of 32-bit numbers, by one call for all of
    them: with single blanks between, no pre-token reaches over a word's ends. Words with other signs or
    a special token are left out. None where a blank does not belong to the word behind it."""
    import tiktoken

    found = merges(path)
    special = json.loads(tokenizer(path).to_str())["added_tokens"]
    if found is None or found[0] is not WITH_BLANK or any(
            t["lstrip"] or t["rstrip"] or not t["content"] or re.search(r"\s", t["content"]) for t in special):
        return None
    _, ranks, ids, _ = found
    at_once = tiktoken.Encoding("many", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
    id_of = np.array(ids, dtype="<u4")
    begins = np.zeros(len(ids), dtype=bool)
    begins[[r for token, r in ranks.items() if token.startswith(b" ")]] = True
    barred = re.compile("|".join(re.escape(t["content"]) for t in special)) if special else None

    def run(words: list[str]) -> dict[str, bytes]:
        words = [w for w in words if KNOWN_SIGNS.fullmatch(w) and not (barred and barred.search(w))]
        if not words:
            return {}
        got = at_once.encode_to_numpy(" " + " ".join(words), allowed_special=set(), disallowed_special=())
        first = np.flatnonzero(begins[got])
        out, ends = id_of[got].tobytes(), [*(first * 4).tolist(), len(got) * 4]
        return {w: out[a:b] for w, a, b in zip(words, ends[:-1], ends[1:], strict=True)}

    return run


def alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return names | {chr(256 + i): b for i, b in enumerate(rest)}


def ids_by(path: str) -> Callable[[str], list[int]]:
    """The ids of a text; a word of letters goes the fast way where the vocabulary has one."""
    if path not in _quick:
        _quick[path] = ranked(path)
    encoder = tokenizer(path)
    if _quick[path] is None:
        return lambda text: encoder.encode(text, add_special_tokens=False).ids
    words, quick = _quick[path]
    return lambda text: quick(text) if words.fullmatch(text) else encoder.encode(text, add_special_tokens=False).ids


# White space other than blank, newline, tab and carriage return. A text that has any is cut
# nowhere near it.
RARE_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
