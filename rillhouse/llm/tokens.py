"""Token ids by the tokenizers library, with a memory of chunks of text."""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np

#: The characters with Unicode's White_Space property (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Beyond this many entries a worker's memory becomes the old one, which is asked second.
MEMORY = 300_000
_W = f"[{SPACE}]"
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
#: How the two vocabularies split text, here for ASCII and Latin-1 letters (fixed values).
_SPLITS = {
    True: rf" ?[{_L}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+",
    False: rf"[{_L}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\s{_L}0-9]+",
}
_KNOWN = re.compile(rf"[\x00-\x7f{_L}]*")
#: The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves,
#: the others in order from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PLAIN} | {
    b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))
}


#: What a vocabulary's file says where the splits above are its own (fixed values), by ``spaces``.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SAYS = {
    True: (None, {**_BYTE_LEVEL, "use_regex": True}),
    False: (
        {
            "type": "Sequence",
            "normalizers": [
                {"type": "NFC"},
                {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                {"type": "Lowercase"},
            ],
        },
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed",
                 "invert": True},
                {**_BYTE_LEVEL, "use_regex": False},
            ],
        },
    ),
}


def known(path: str, spaces: bool) -> bool:
    """Whether a vocabulary's file splits text as is done here, and has no other special texts."""
    with open(path, encoding="utf-8") as file:
        says = json.load(file)

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items() if k != "trim_offsets"}
        return [plain(v) for v in x] if isinstance(x, list) else x

    model = says["model"]
    usual = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "fuse_unk")
    )
    marked = all("<|" in t["content"] for t in says["added_tokens"])
    found = (plain(says["normalizer"]), plain(says["pre_tokenizer"]))
    return usual and marked and found == _SAYS[spaces]


class Memory(dict):
    """Ids, as bytes, of the parts of texts that were seen; new parts are found by ``find``."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find, self.old = find, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self.find(part)
        self[part] = ids
        return ids

    def ids(self, parts: list[str]) -> np.ndarray:
        if len(self) > MEMORY:
            self.old = self.copy()
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, parts)), dtype="<u4")


class Encoder:
    """Encodes like ``Tokenizer.encode(text, add_special_tokens=False)``.

    A text of ASCII and Latin-1 letters is split here as the vocabulary's pattern splits it, and the
    parts go to the library's model, without its normalizer and bookkeeping of offsets; a part has
    the same ids wherever it stands. Of any other text, neither pattern lets a token reach from a
    character into the white space after it, so it may be cut before every run of white space;
    these chunks go to the library whole. ``spaces`` says whether white space has ids. A vocabulary
    whose file says anything else goes to the library with every text whole.
    """

    def __init__(self, path: str, spaces: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        lead, tail = (f"{_W}*", f"|{_W}+") if spaces else ("", "")
        self.chunks = re.compile(f"{lead}[^{SPACE}]+{tail}").findall
        self.split = re.compile(_SPLITS[spaces], re.ASCII).findall
        self.spaces, self.known = spaces, known(path, spaces)
        self.parts, self.wholes = Memory(self.part), Memory(self.whole)

    def part(self, part: str) -> bytes:
        return pack(self.tokenize(part.encode().decode("latin-1").translate(_BYTES)))

    def whole(self, chunk: str) -> bytes:
        found = self.tokenizer.encode(chunk, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not self.known:
            return np.frombuffer(self.whole(text), dtype="<u4")
        if "<|" not in text and (text.isascii() or _KNOWN.fullmatch(text)):
            return self.parts.ids(self.split(text if self.spaces else text.lower()))
        return self.wholes.ids(self.chunks(text))


def pack(tokens: list) -> bytes:
    """Ids of tokens as little-endian unsigned 32-bit numbers."""
    if len(tokens) == 1:
        return tokens[0].id.to_bytes(4, "little")
    return b"".join([t.id.to_bytes(4, "little") for t in tokens])


@cache
def encoder(path: str, spaces: bool) -> Encoder:
    """One per worker and vocabulary."""
    return Encoder(path, spaces)
