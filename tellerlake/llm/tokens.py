"""Token ids of whole texts with a public tokenizer file, fast for prose.

White space never becomes part of a token of the tokenizers used here, so a text's ids are the ids
of its words one after the other. Each worker keeps the ids of the words it has met; plain words
go straight to the tokenizer's own model, anything else through the whole tokenizer.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from tellerlake.llm.common import worker_state

CACHED_WORDS = 400_000
LONGEST_CACHED = 64
# Lower-case letters that normal form C and lower-casing leave alone, or change one by one.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)\Z")
# White space for Python, but not for the tokenizer.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write byte b as this letter: itself if printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def splits_at_space(tokenizer) -> bool:
    """Whether the tokenizer is of the kind above: white space dropped, words lower-cased, byte-level with word ends."""
    return tokenizer.encode("Ab, cd", add_special_tokens=False).ids == [
        i for w in ("ab", ",", "cd") for i in tokenizer.encode(w, add_special_tokens=False).ids
    ] and tokenizer.encode(" \n ", add_special_tokens=False).ids == []


def make_encoder(path: str) -> Callable[[str], bytes]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    if not splits_at_space(tokenizer):
        return whole
    model, letters = tokenizer.model, byte_letters()
    marks = {m: whole(m) for m in ("", ".", ",")}
    known: dict[str, bytes] = {}

    def plain(word: str) -> bytes:
        found = known.get(word)
        if found is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
            found = np.array([t.id for t in model.tokenize(shown)], dtype="<u4").tobytes()
            if len(word) <= LONGEST_CACHED:
                known[word] = found
        return found

    def one(word: str) -> bytes:
        parts = PLAIN.match(word)
        return plain(parts[1].lower()) + marks[parts[2]] if parts and len(word) <= LONGEST_CACHED else whole(word)

    def encode(text: str) -> bytes:
        if ODD_SPACE.search(text):
            return whole(text)
        words = text.split()
        new = set(words).difference(known)
        if len(known) > CACHED_WORDS:
            known.clear()
            new = set(words)
        for word in new:
            known[word] = one(word)
        data = b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > LONGEST_CACHED:
                del known[word]
        return data

    return encode


def encoder(path: str) -> Callable[[str], bytes]:
    """Text to little-endian 32-bit ids, without special tokens around it; one per worker process and file."""
    made = worker_state().setdefault("encoders", {})
    if path not in made:
        made[path] = make_encoder(path)
    return made[path]
