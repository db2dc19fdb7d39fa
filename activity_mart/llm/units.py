"""Public tokenizers applied to short units of text whose results are remembered.

Byte-level BPE after the usual splitting pattern, and the lower-casing word BPE, never join
characters across the start of a run of white space. A text can therefore be cut there into
units, and a unit's ids are the same wherever it stands. A worker remembers the ids of units it
has met, up to a fixed number (some 300 MB), and gives only new ones to the library.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array
from collections.abc import Callable
from itertools import islice

import numpy as np

# Unicode white space.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
REMEMBERED_UNITS, REMEMBERED_PARTS = 400_000, 1_200_000
WORD_UNITS = f"[^{SPACE}]+"
CONTROLS = re.compile("[\x1c-\x1f]")
# Units of plain Latin letters, digits and marks, which the word BPE's rules split into these parts. An
# apostrophe may take a letter with it, and a special token is found before splitting.
PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
# Texts that can be folded to lower case before they are cut, so that fewer units differ.
PLAIN_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def tokenizer_path(name: str) -> str:
    """A file of the public vocabularies, or ``name`` itself if it is a path."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Ids by unit; a plain unit that is asked for first is learned then."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self.learn(unit)
        return ids


class UnitEncoder:
    """Ids and counts of texts by a ``tokenizers`` file, without special tokens added."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.units = self._units(path)
        self.known: dict[str, bytes] = _Known(self._of_model)
        self.parts: dict[str, bytes] = {}
        suffix = self._word_end(path)
        self.ends_word = None
        self.byte_letters = self._byte_letters(path) if suffix and self.units else None
        self.ask = self.tokenizer.model.tokenize if self.byte_letters is not None else None
        if suffix and self.units:
            tokens = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends_word = np.zeros(max(tokens.values()) + 1, dtype=bool)
            self.ends_word[[i for t, i in tokens.items() if t.endswith(suffix)]] = True

    @staticmethod
    def _units(path: str):
        """The pattern of units, or None if this file's rules aren't known to allow cutting."""
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        before, split = rules["normalizer"], rules["pre_tokenizer"] or {}
        plain_added = not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(f"[{SPACE}]", t["content"])
            for t in rules["added_tokens"]
        )
        if not plain_added:
            return None
        if before is None and split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
            return re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        steps = [s.get("type") for s in (before or {}).get("normalizers", [])]
        first = (split.get("pretokenizers") or [{}])[0]
        words_only = first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
        if steps == ["NFC", "Replace", "Lowercase"] and words_only and "[^\\s" in first["pattern"]["Regex"]:
            return re.compile(WORD_UNITS)
        return None

    @staticmethod
    def _byte_letters(path: str) -> dict[int, str] | None:
        """The letters that stand for the bytes beyond ASCII, if the model can be asked for a word's ids by itself."""
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        alone = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        if not alone or sys.byteorder != "little" or rules["model"].get("dropout") or not all("<|" in t["content"] for t in rules["added_tokens"]):
            return None
        moved = [*range(0x80, 0xA1), 0xAD]  # bytes without a letter of their own, after the 33 of ASCII
        return {byte: chr(0x100 + 34 + i) for i, byte in enumerate(moved)}

    @staticmethod
    def _word_end(path: str) -> str | None:
        with open(path, encoding="utf-8") as file:
            return json.load(file)["model"].get("end_of_word_suffix")

    def _learn_words(self, units: list[str]) -> list[str]:
        """Put plain units among the known ones; the others are returned.

        Their parts are single words to the tokenizer. Its model gives their ids one by one where the rules before it
        are known; else many go to the library as one text, whose ids are cut again after each id that ends a word.
        """
        if self.ask:
            plain = {u for u in units if "<|" not in u and PLAIN.fullmatch(u)}
            self.known.update((u, self._of_model(u)) for u in plain)
            return [u for u in units if u not in plain]
        cut = {u: PARTS.findall(u.lower()) for u in units if "<|" not in u and PLAIN.fullmatch(u)}
        new = list({p for parts in cut.values() for p in parts if p not in self.parts})
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(ends) != len(some):
                raise ValueError("the tokenizer splits words that its rules don't")
            data = ids.tobytes()
            self.parts.update(zip(some, [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], strict=True))
        self.known.update((u, b"".join([self.parts[p] for p in parts])) for u, parts in cut.items())
        return [u for u in units if u not in cut]

    def _of_model(self, unit: str) -> bytes:
        """Ids of a plain unit from the model, part by part."""
        parts = self.parts
        made = []
        for part in [unit] if unit.isalpha() and unit.islower() else PARTS.findall(unit.lower()):
            if (ids := parts.get(part)) is None:
                word = part if part.isascii() else part.encode().decode("latin-1").translate(self.byte_letters)
                ids = parts[part] = array("I", [t.id for t in self.ask(word)]).tobytes()
            made.append(ids)
        return made[0] if len(made) == 1 else b"".join(made)

    def _ids(self, encoding) -> bytes:
        return np.array(encoding.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.units is None:
            return [self._ids(self.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
        # str.split parts a text at white space as SPACE has it, and at four control characters besides.
        spaced = self.units.pattern == WORD_UNITS
        plain = [False] * len(texts)
        if self.ends_word is not None:
            plain = ["<|" not in t and PLAIN_TEXT.fullmatch(t) is not None for t in texts]
            texts = [t.lower() if p else t for t, p in zip(texts, plain, strict=True)]
        cut = [t.split() if spaced and not CONTROLS.search(t) else self.units.findall(t) for t in texts]
        known = self.known
        if len(known) > REMEMBERED_UNITS:
            known.clear()
        if len(self.parts) > REMEMBERED_PARTS:
            self.parts.clear()
        # Texts of plain units alone need no look ahead: their units are learned one by one as they come.
        ahead = [c for c, t, p in zip(cut, texts, plain, strict=True) if not (p and self.ask) or "'" in t]
        unknown = list(set().union(*ahead) - known.keys())
        new = iter(self._learn_words(unknown) if self.ends_word is not None else unknown)
        while part := list(islice(new, 5_000)):
            known.update(zip(part, map(self._ids, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))
        return [b"".join(map(known.__getitem__, units)) for units in cut]


@functools.lru_cache(maxsize=4)
def unit_encoder(path: str) -> UnitEncoder:
    """One per worker process and file."""
    return UnitEncoder(path)
