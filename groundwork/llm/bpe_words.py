"""How a lower-casing word BPE vocabulary (one whose pieces end in a word-end suffix) sees a text.

White space is dropped and no piece spans it, so a text is read as chunks between spaces. A chunk of printable
ASCII and Latin-1 letters and signs is lower-cased and split into pieces here; any other chunk, and any that may
hold a special string, is left to the tokenizers library as a whole.
"""

from __future__ import annotations

import json
import os

import regex

from groundwork.llm.common import until_freed

_PLAIN = regex.compile(r"[!-~¡-ÿ]*")


def byte_letters() -> str:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    table, spare = [], 256
    for b in range(256):
        if b in shown:
            table.append(chr(b))
        else:
            table.append(chr(spare))
            spare += 1
    return "".join(table)


class WordVocabulary:
    """The vocabulary file and its library tokenizer; pieces() gives the byte-level pieces of a plain chunk."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"]) for t in spec["added_tokens"])
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or level["type"] != "ByteLevel" or level["add_prefix_space"] or not plain or spec["post_processor"]:
            raise ValueError(f"{path} is not a vocabulary of lower-cased words without white space")
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.decoder = spec["decoder"]
        self.vocab: dict[str, int] = dict(spec["model"]["vocab"])
        self.merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._mark = os.path.commonprefix(list(self.added))
        self._split = regex.compile(split["pattern"]["Regex"])
        letters = byte_letters()
        self._bytes = {i: c for i, c in enumerate(letters)}

    @property
    def tokens(self) -> dict[int, str]:
        return {i: t for t, i in (self.vocab | self.added).items()}

    def to_letters(self, piece: str) -> str:
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._bytes)

    def pieces(self, chunk: str) -> list[str] | None:
        """Byte-level pieces of a plain chunk; None for a chunk that the library must take whole."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
            if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
                return [chunk[:-1].lower(), chunk[-1]]
        if not _PLAIN.fullmatch(chunk) or (self._mark in chunk and any(c in chunk for c in self.added)):
            return None
        return [self.to_letters(p) for p in self._split.findall(chunk.lower())]


def chunks(text: str) -> list[str]:
    """The text between spaces and line ends; empty chunks have no tokens."""
    return text.replace("\n", " ").split(" ")


@until_freed
def vocabulary(path: str) -> WordVocabulary:
    return WordVocabulary(path)
