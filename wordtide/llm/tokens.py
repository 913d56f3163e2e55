"""Token ids of whole texts by the tokenizers library, each different word encoded once per worker.

Texts are cut only where the tokenizer itself always cuts: before a single space that a word follows, or, for
tokenizers that drop white space, at any space or line end; and between a Latin letter and a mark that ends a clause, as
both tokenizers keep letters and marks apart. So the ids of the parts, one after the other, are the ids of the text, and
a word is the same with and without a comma. The tokenizer files are named by ``public_tokenizers.path``; another path can be given.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

# Words that one worker remembers: up to half of them that were met lately, and those that were met lately before.
REMEMBERED = 1_600_000

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

_before_word = re.compile(r" (?=\S)")
_space = re.compile(r"\s")
_before_mark = re.compile(r"[.,;:!?](?<=[A-Za-zÀ-ÖØ-öø-ÿ].)")
_odd_space = re.compile(r" (?!\S)")


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer; a name with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_digest(name: str) -> str:
    """Digest of the tokenizer's file and of the library's version: equal digests give equal ids."""
    import tokenizers

    with open(tokenizer_path(name), "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


class WordEncoder:
    """Encodes texts as little-endian 32-bit ids. Kept by the worker, so later batches know its words."""

    def __init__(self, name: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.keeps_space = name.endswith(BYTE_BPE)
        if not self.keeps_space and not name.endswith(WORD_BPE):
            raise ValueError(f"no cutting rule is known for {name}")
        # A mark between words: a line end, or a special token where white space is dropped.
        self.mark = "\n" if self.keeps_space else "<|startoftext|>"
        self.mark_id = self.plain([self.mark])[0]
        # Ids that only stand at one end of a word of letters: the first if its space is kept, else the last.
        tokens = self.library.get_vocab()
        self.edge = np.zeros(max(tokens.values()) + 1, bool)
        at_edge = [i for t, i in tokens.items() if (t.startswith("Ġ") if self.keeps_space else t.endswith("</w>"))]
        self.edge[at_edge] = True
        # Every word has one, as every byte does.
        self.has_edges = "Ġ" in tokens if self.keeps_space else sum(t.endswith("</w>") and len(t) == 5 for t in tokens) >= 256
        # Whether A-Z may be lowered beforehand, so that a word is encoded once for all of its cases.
        steps = (json.loads(self.library.to_str())["normalizer"] or {}).get("normalizers", [])
        self.lowers = not self.keeps_space and [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        if len(self.mark_id) != 4:
            raise ValueError("the mark must be one token")

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def lowered(self, text: str) -> str:
        """The text with A-Z in lower case if its ids stay the same: no special token can arise, and small letters must not
        combine with marks that stand alone after capitals."""
        if "<|" in text:
            return text
        lower = text.encode().lower().decode()
        return lower if unicodedata.is_normalized("NFC", lower) else text

    def parts(self, text: str) -> list[str]:
        if self.lowers:
            text = self.lowered(text)
        if "\0" not in text:
            marked = _before_mark.sub("\0\\g<0>", text)
            if self.keeps_space:
                spaced = _before_word.sub("\0 ", marked) if _odd_space.search(marked) else marked.replace(" ", "\0 ")
                return spaced.split("\0")
            return marked.replace("\n", "\0").replace(" ", "\0").split("\0")
        if self.keeps_space:
            first, *rest = _before_word.split(text)
            return [first, *[f" {x}" for x in rest]]
        return text.replace("\n", " ").split(" ")

    def learn(self, words: Iterable[str]) -> None:
        odd, simple, letters = [], [], []
        for word in words:
            inner = word[1:] if self.keeps_space else word
            if inner.isalpha() and self.has_edges and (word[0] == " " or not self.keeps_space):
                letters.append(word)
                continue
            plain = word[:1] == " " if self.keeps_space else word
            (simple if plain and not _space.search(inner) and "<|" not in word else odd).append(word)
        for i in range(0, len(letters), 1_000):
            some = letters[i : i + 1_000]
            ids = self.plain([("" if self.keeps_space else " ").join(some)])[0]
            at = np.flatnonzero(self.edge[np.frombuffer(ids, "<u4")]) * 4
            ends = [*at[1:].tolist(), len(ids)] if self.keeps_space else (at + 4).tolist()
            if len(ends) == len(some) and ends[-1] == len(ids):
                self.known.update((w, ids[a:b]) for w, a, b in zip(some, [0, *ends], ends))
            else:  # letters that the tokenizer takes for something else
                simple += some
        for i in range(0, len(simple), 4_000):
            some = simple[i : i + 4_000]
            ids = self.plain([self.mark + self.mark.join(some) + self.mark])[0]
            at = np.flatnonzero(np.frombuffer(ids, "<u4") == int.from_bytes(self.mark_id, "little"))
            if len(at) == len(some) + 1:
                ends = (at * 4).tolist()
                self.known.update((w, ids[a + 4 : b]) for w, a, b in zip(some, ends, ends[1:]))
            else:  # a word's own ids hold the mark
                odd += some
        for i in range(0, len(odd), 1_000):
            self.known.update(zip(odd[i : i + 1_000], self.plain(odd[i : i + 1_000])))

    def encode(self, texts: Iterable[str]) -> Iterable[bytes]:
        """Ids of each text, in order. Works on some texts at a time, so a long list needs no more memory."""
        for some in _portions(texts):
            cut = [self.parts(text) for text in some]
            new = set().union(*cut)
            new.difference_update(self.known)
            if len(self.known) + len(new) > self.remembered // 2:
                self.known, self.older = {}, self.known
                new = set().union(*cut)
            again = new & self.older.keys()
            self.known.update((word, self.older[word]) for word in again)
            self.learn(new - again)
            for words in cut:
                yield b"".join(map(self.known.__getitem__, words))


def _portions(texts: Iterable[str], size: int = 2_000_000) -> Iterable[list[str]]:
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held > size:
            yield some
            some, held = [], 0
    if some:
        yield some


@lru_cache(2)
def encoder(name: str, remembered: int = REMEMBERED) -> WordEncoder:
    return WordEncoder(name, remembered)
