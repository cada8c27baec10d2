"""Byte-level BPE of whole texts from cached parts.

A byte-level BPE encodes every match of its split pattern on its own. A single
space between two non-white characters always starts a match, so a text may be
cut there and each part encoded alone. Parts and matches repeat, hence two
caches per worker: part -> id bytes, and match -> id bytes. Ids are kept as
little-endian unsigned 32-bit integers, the form every caller hashes or stores.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import regex

#: Entries of one generation of a cache; two generations are kept.
CACHE_ENTRIES = 250_000
#: Longer parts are not kept.
CACHE_CHARS = 64

_CLOSE_WHITE = re.compile(r" \s|[^\S ] ")
#: White space besides the blank and the line feed.
_ODD_WHITE = tuple(c for c in map(chr, range(0x3001)) if c not in " \n" and re.match(r"\s", c))
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_MARKS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
#: Below this, str.isalpha and the pattern's letter class agree in every Unicode version.
_LATIN_END = "\u0370"


def _has_close_white(text: str) -> bool:
    """Whether a blank stands next to other white space."""
    for c in _ODD_WHITE:
        if c in text:
            return _CLOSE_WHITE.search(text) is not None
    return "  " in text or " \n" in text or "\n " in text


class _Cache(dict):
    """Values made on first use, in two generations of at most ``CACHE_ENTRIES`` short keys.

    A full generation becomes the older one and replaces it; keys used again come
    back from there. What is frequent stays, whatever came first.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHE_CHARS:
                return value
        if len(self) >= CACHE_ENTRIES:
            self.older = self.copy()
            self.clear()
        self[key] = value
        return value


class TextEncoder:
    """Texts to id bytes with ``encode_match`` for each match of ``pattern``.

    ``encode_word``, where given, does the same for a blank and a Latin word, given
    the word.
    """

    def __init__(self, pattern: str, encode_match: Callable[[str], bytes],
                 encode_word: Callable[[str], bytes] | None = None):
        self._find = regex.compile(pattern).findall
        self._word = encode_word or (lambda word: encode_match(" " + word))
        self._match = _Cache(encode_match)
        self._first = _Cache(self._searched)
        self._rest = _Cache(self._spaced)

    def _searched(self, part: str) -> bytes:
        return b"".join(map(self._match.__getitem__, self._find(part)))

    def _spaced(self, part: str) -> bytes:
        """Ids of a part behind its space; a Latin word, with marks behind it or not,
        needs no search."""
        if part.isalpha():
            if part.isascii() or max(part) < _LATIN_END:
                return self._word(part)
            return self._searched(" " + part)
        word = part.rstrip(_MARKS)
        if word.isalpha() and (word.isascii() or max(word) < _LATIN_END):
            return self._rest[word] + self._match[part[len(word):]]
        return self._searched(" " + part)

    def encode(self, text: str) -> bytes:
        parts = _SAFE_SPACE.split(text) if _has_close_white(text) else text.split(" ")
        return self._first[parts[0]] + b"".join(map(self._rest.__getitem__, parts[1:]))


def ids_to_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


def _printable_bytes() -> dict[int, str]:
    """Byte-level vocabularies write a byte as one character: visible Latin-1
    characters stand for themselves, the rest are moved up to 256 in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = (b for b in range(256) if b not in kept)
    return {b: chr(256 + k) for k, b in enumerate(moved)}


class AddedTokenEncoder:
    """Like the library's ``encode``: added tokens in a text have their own ids.

    The text between them goes to ``plain``. Tokens that take white space around
    them along or match whole words only leave their texts to the library itself.
    """

    def __init__(self, plain: TextEncoder, tokenizer):
        added = {t.content: (k, t) for k, t in tokenizer.get_added_tokens_decoder().items()
                 if t.content}
        self._plain, self._tokenizer = plain, tokenizer
        self._ids = {content: ids_to_bytes([k]) for content, (k, _) in added.items()}
        self._exact = not any(t.lstrip or t.rstrip or t.single_word for _, t in added.values())
        longest_first = sorted(added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def encode(self, text: str) -> bytes:
        if not any(content in text for content in self._ids):
            return self._plain.encode(text)
        if not self._exact:
            return ids_to_bytes(self._tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(self._ids[part] if k % 2 else self._plain.encode(part)
                        for k, part in enumerate(self._cut.split(text)))


# The parts of a tokenizer file that make it a byte-level BPE over the matches of
# ``public_tokenizers.PATTERN``, which is what ``TextEncoder`` computes.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
_PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "byte_fallback": False,
                "continuing_subword_prefix": None, "end_of_word_suffix": None,
                "ignore_merges": False}


def check_byte_level(name: str, written: str) -> None:
    """Refuse a tokenizer (its JSON text) whose ids the cached parts would not give."""
    parts = json.loads(written)
    before, model = parts.get("pre_tokenizer") or {}, parts.get("model") or {}
    wrong = [key for key, fixed in (("pre_tokenizer", _BYTE_LEVEL), ("model", _PLAIN_MODEL))
             for k, v in fixed.items()
             if (before if key == "pre_tokenizer" else model).get(k, v if v in (None, False) else 0)
             not in (v, "" if v is None else v)]
    if parts.get("normalizer") is not None:
        wrong.append("normalizer")
    if wrong:
        raise ValueError(f"{name} is no plain byte-level BPE (its {', '.join(sorted(set(wrong)))})")


_LOADED: dict[tuple[str, bool], TextEncoder | AddedTokenEncoder] = {}


def library_encoder(name: str, added_tokens: bool = False) -> TextEncoder | AddedTokenEncoder:
    """Encoder of a ``tokenizers`` file by its name; one per worker process.

    The library's model encodes every match. With ``added_tokens`` the strings of
    the tokenizer's added tokens are these tokens, as in the library's ``encode``
    with its defaults; without, they are ordinary text (``encode_special_tokens``).
    """
    key = (name, added_tokens)
    if key not in _LOADED:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        check_byte_level(name, tokenizer.to_str())
        model = tokenizer.model
        shown = _printable_bytes()
        space = shown[32]
        shown_byte = [shown.get(k, chr(k)) for k in range(256)].__getitem__
        tokenize = model.tokenize

        def encode_match(match: str) -> bytes:
            spaced = match[0] == " "
            if match.isascii() and match[spaced:].isalnum():
                name = space + match[1:] if spaced else match
            else:
                name = "".join(map(shown_byte, match.encode()))
            return array("I", [t.id for t in tokenize(name)]).tobytes()

        def encode_word(word: str) -> bytes:
            name = word if word.isascii() else "".join(map(shown_byte, word.encode()))
            return array("I", [t.id for t in tokenize(space + name)]).tobytes()

        plain = TextEncoder(public_tokenizers.PATTERN, encode_match, encode_word)
        _LOADED[key] = AddedTokenEncoder(plain, tokenizer) if added_tokens else plain
    return _LOADED[key]
