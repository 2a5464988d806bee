"""Whole-text encoding with the ``tokenizers`` library, one call a new word.

Encoding a text of invented or rare words costs the library some ten
microseconds a word. Two public tokenizers split text into words before any
merge, so a text's ids are the ids of its words put together. The encoder
splits texts made of characters whose classes are stable across Unicode
versions, asks the library for words it has not met, and remembers them in
tables of bounded size. Any other text goes to the library whole; so does
one that holds the string of an added token, which the library takes for that
token, and every text of a tokenizer with other rules than the two known.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼½¾"
OTHER = rf"[^\s{LETTERS}{DIGITS}]"
# Characters that the splits below class exactly as the library does.
SPACES = re.compile(r"\s\s")
PLAIN = re.compile("[^\t\n\r -~\xa0-ɏ]")
# The two tokenizers' own split rules, in plain characters.
SPLITS = {
    "byte": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?{OTHER}+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|{OTHER}+"),
}
# The library's names of the two tokenizers' rules.
RULES = {
    "byte": (None, ["ByteLevel"]),
    "word": (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]),
}
SPLIT_RULE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# A byte's sign in byte-level vocabularies: itself where it is a visible
# Latin-1 character, else the next character from 256 on.
_HIDDEN = [b for b in range(256) if b < 33 or 127 <= b <= 160 or b == 173]
BYTE_SIGNS = {b: chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)}
HELD = 600_000  # words, and as many runs between spaces (or both together), that a worker remembers


class _Held(dict):
    """Answers that are worked out once, at most ``HELD`` at a time."""

    def __init__(self, work, most: int):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.work(key)
        return value


def _steps(rule: dict | None) -> list[dict]:
    return [] if rule is None else rule.get("normalizers") or rule.get("pretokenizers") or [rule]


def kind_of(file: dict) -> str | None:
    """Which of ``RULES`` a tokenizer's file has, if any."""
    normal, parts = _steps(file.get("normalizer")), _steps(file.get("pre_tokenizer"))
    found = ([s["type"] for s in normal] or None, [s["type"] for s in parts])
    kind = next((k for k, rules in RULES.items() if rules == found), None)
    if file.get("truncation") or file.get("padding") or file["model"].get("ignore_merges") or kind is None:
        return None
    last = parts[-1]
    fits = not last["add_prefix_space"] and last.get("use_regex", True) == (kind == "byte")
    if kind == "word":
        fits = fits and parts[0]["pattern"] == {"Regex": SPLIT_RULE} and parts[0]["invert"] and (
            parts[0]["behavior"] == "Removed" and normal[1]["pattern"] == {"Regex": r"\s+"} and normal[1]["content"] == " ")
    return kind if fits else None


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes, as the library's
    ``encode`` with ``add_special_tokens=False`` gives them."""

    def __init__(self, path: str, held: int = HELD):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = kind_of(json.loads(self.tokenizer.to_str()))
        self.split = SPLITS.get(self.kind)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Lower-case and upper-case alike: some are looked for in folded text.
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE)
        # For words that are split and lower-cased already; the merges alone.
        self.merge = self.tokenizer.model.tokenize
        self.words = _Held(self._word, held)
        # Without the space before it, a run that is one word is that word:
        # one table then holds both.
        self.runs = _Held(self._run, held) if self.kind != "word" else self.words

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def _word(self, word: str) -> bytes:
        if self.kind == "word":  # or a run of several
            parts = self.split.findall(word)
            if parts != [word]:
                return b"".join(map(self.words.__getitem__, parts))
        tokens = self.merge(word.encode().decode("latin-1").translate(BYTE_SIGNS))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split.findall(text)))

    def _run(self, run: str) -> bytes:
        """A run's ids; in a byte-level vocabulary with the space before it."""
        return self._split(" " + run if self.kind == "byte" else run)

    def _is_odd(self, text: str) -> bool:
        """Whether a text goes to the library whole."""
        return self.kind is None or bool(PLAIN.search(text) or self.added.search(text))

    def _splits_at_spaces(self, text: str) -> bool:
        """Whether the ids are those of the runs between single spaces."""
        if self._is_odd(text):
            return False
        return self.kind == "word" or not (text[:1] == " " or text[-1:] == " " or SPACES.search(text))

    def _by_runs(self, texts: list[str]) -> list[bytes]:
        """All texts at once: each distinct run is looked up once."""
        runs = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = runs.flatten().dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        ids = [*map(self.runs.__getitem__, distinct)]
        begins = runs.offsets.to_numpy()
        if self.kind == "byte":  # a text's first run has no space before it
            codes = codes.copy()
            first = [distinct[c] for c in codes[begins[:-1]]]
            codes[begins[:-1]] = np.arange(len(ids), len(ids) + len(first))
            ids += map(self._split, first)
        lengths = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        all_ids = np.frombuffer(b"".join(ids), "<u4")
        own = lengths[codes]
        ends = np.cumsum(own)
        at = (np.cumsum(lengths) - lengths)[codes] - (ends - own)
        flat = all_ids[np.repeat(at, own) + np.arange(ends[-1])].tobytes()
        cuts = 4 * np.concatenate([[0], ends])[begins]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _alone(self, text: str) -> bytes:
        if not text:
            return b""
        return self.whole([text])[0] if self._is_odd(text) else self._split(text)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if self.kind == "word":
            texts = [t if self._is_odd(t) else t.lower() for t in texts]
        fit = [self._splits_at_spaces(t) for t in texts]
        found = iter(self._by_runs([t for t, f in zip(texts, fit) if f]) if any(fit) else ())
        return [next(found) if f else self._alone(t) for t, f in zip(texts, fit)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file; workers live longer than tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
