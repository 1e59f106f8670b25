"""Byte-level tokenizers, word by word.

Encoding a text spends most of its time on normalising and splitting it. For words of plain characters, whose splitting a short
pattern says, only the tokenizer's own model is asked, which takes a fraction of the time; any other word goes through the
whole tokenizer. Tests hold both against each other.
"""

from __future__ import annotations

import os
import re

#: Plain characters: ASCII, and Latin letters that normal forms leave alone and whose lower case is one letter.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
PLAIN = re.compile(f"[\\x21-\\x7E{LETTERS}]+")
#: How the two kinds of tokenizers split plain text.
WORD_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
SPACED_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ {LETTERS}0-9]+")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level tokenizers write bytes: printable ones stand for themselves, the others are counted
    up from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


_SHOWN = {b: c for c, b in byte_alphabet().items()}
_SPACE = _SHOWN[0x20]


class ByteLevel:
    """``path``: a tokenizer's file. ``spaced``: words may begin with one space, which belongs to them; else case is folded and
    words hold no space. ``plain_specials``: strings of special tokens are ordinary text."""

    def __init__(self, path: str, spaced: bool, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.spaced, self.parts = spaced, SPACED_PARTS if spaced else WORD_PARTS
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # No plain word holds a special token unless it holds the token's first two characters.
        self.specials = () if plain_specials else tuple({c[:2] for c in contents})

    def whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def ids(self, words: list[str]) -> list[list[int]]:
        tokenize, parts, spaced, plain, out = self.tokenizer.model.tokenize, self.parts.findall, self.spaced, PLAIN.fullmatch, []
        every = "\n".join(words)
        special = [s for s in self.specials if s in every]
        for word in words:
            if not spaced and word.isascii() and word.isalpha():
                out.append([t.id for t in tokenize(word.lower())])
                continue
            if spaced and word.isascii() and word[:1] == " " and word[1:].isalpha():
                out.append([t.id for t in tokenize(_SPACE + word[1:])])
                continue
            body = word[1:] if spaced and word[:1] == " " else word
            if not plain(body) or (special and any(s in body for s in special)):
                out.append(self.whole(word))
                continue
            ids: list[int] = []
            word = word if spaced else word.lower()
            for shown in [word] if body.isalpha() else parts(word):
                if spaced or not shown.isascii():
                    shown = shown.encode().decode("latin-1").translate(_SHOWN)
                ids += [t.id for t in tokenize(shown)]
            out.append(ids)
        return out
