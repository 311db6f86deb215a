"""Token ids of whole texts by a `tokenizers` file, with the ids of each word kept.

A word-level tokenizer drops white space and never joins across it, so a text's ids are those of its blank-separated strings
in a row. For such a file (lower case, BPE with word ends) each string is looked at once: plain Latin ones are cut up by the
file's own pattern and its model is asked for each word, others go through ``encode``. So do files of another kind, whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
LETTERS = "a-zªµºß-öø-ÿœ"
PLAIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9²³¹¼½¾]|[^\\s{LETTERS}0-9²³¹¼½¾]+")
OTHER = "[^\t\n\r -~¡-ÿŒœ]"
#: A word, or a word and a mark after it: most strings, told by one look.
SIMPLE = re.compile("([A-Za-zªµºÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]?)")
#: Words that are kept, strings of each of two generations, and the longest of them.
KEPT_WORDS = 300_000
KEPT_STRINGS = 80_000
LONGEST_KEPT = 200


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level models use for bytes: printable Latin-1 as itself, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Strings(dict):
    """What is known about strings, in two generations: one that is met again moves to the younger."""

    def __init__(self, find: Callable[[bytes], bytes]) -> None:
        self.find, self.older = find, {}

    def turn(self) -> None:
        if len(self) > KEPT_STRINGS:
            self.older = dict(self)
            self.clear()

    def __missing__(self, string: bytes) -> bytes:
        got = self.older.get(string)
        if got is None:
            got = self.find(string)
            if len(string) > LONGEST_KEPT:
                return got
        self[string] = got
        return got


class WordIds:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        parts = pre.get("pretokenizers") or [{}]
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == NORMAL
            and parts[0].get("pattern") == {"Regex": PATTERN} and parts[0].get("behavior") == "Removed"
            and [p["type"] for p in parts] == ["Split", "ByteLevel"] and not parts[1].get("use_regex"))
        special = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.whole_only = re.compile("|".join([OTHER, *special]))
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.code = "H" if self.kind == "<u2" else "I"
        self.words: dict[str, bytes] = {}
        self.strings = Strings(self._string)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            shown = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            if len(self.words) > KEPT_WORDS:
                self.words.clear()
            got = self.words[word] = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return got

    def _string(self, string: bytes) -> bytes:
        """Ids of a string without ASCII white space."""
        if string.isalpha():
            return self._word(string.lower().decode())
        text = string.decode()
        simple = SIMPLE.fullmatch(text)
        if simple:
            word, mark = simple.groups()
            return self._word(word.lower()) + self._word(mark) if mark else self._word(word.lower())
        if self.whole_only.search(text):
            return self._whole(text)
        return b"".join(map(self._word, PLAIN.findall(text.lower())))

    def encode(self, text: str) -> bytes:
        """All ids of ``text``, little-endian, ``kind`` wide."""
        if not self.by_word:
            return self._whole(text) if text else b""
        self.strings.turn()
        return b"".join(map(self.strings.__getitem__, text.encode().split()))


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)
