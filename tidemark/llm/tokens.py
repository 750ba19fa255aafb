"""Token ids of texts by public tokenizers, with a cache of the pieces between spaces."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np

from tidemark.llm.common import slices

#: Pieces kept per Python worker, and the longest piece kept; both bound memory only.
CACHE_PIECES = 1 << 18
CACHE_CHARS = 48
#: The special token between joined pieces, the mark by which pieces with special tokens are told, pieces a text.
BETWEEN, MARK, JOINED = "<|endoftext|>", "<|", 256

#: Texts of white space, printable ASCII and Latin-1 letters, which normalising by NFC leaves as they are.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
#: A tokenizer's rule for words, and the same rule for plain texts in lower case.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

_OPEN: dict[tuple[str, str | None], PieceEncoder] = {}


class PieceEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``spaces`` says what the tokenizer does with a single space between two other characters,
    which decides where a text may be cut without changing its ids:

    * ``"dropped"``: white space only separates, so a text may be cut at every space;
    * ``"leading"``: the space belongs to the piece after it. A text with double or edge white
      space at such a cut is encoded whole;
    * ``None``: texts are never cut.

    Pieces repeat, so each is encoded once per worker. The ids equal those of the whole text.
    Where the tokenizer takes lower-case words by ``RULE`` and marks their ends, the pieces of
    plain texts are those words: there are far fewer of them than of pieces between spaces.
    """

    def __init__(self, path: str, spaces: str | None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaces = spaces
        self.between = self.tokenizer.token_to_id(BETWEEN)
        self.ends = _word_ends(self.tokenizer) if spaces == "dropped" else None
        self.known: dict[str, bytes | None] = {}
        self.first: dict[str, bytes | None] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of many short texts: joined by a special token, which the tokenizer splits at first."""
        if self.between is None:
            return self._direct(texts)
        plain = [t for t in texts if MARK not in t]
        found: list[bytes] = []
        for a in range(0, len(plain), JOINED):
            joined = BETWEEN.join(plain[a : a + JOINED])
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            data, cuts = ids.tobytes(), (np.flatnonzero(ids == self.between) * 4).tolist()
            found += [data[x:y] for x, y in zip([0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True)]
        if len(plain) == len(texts):
            return found
        rest, known = iter(self._direct([t for t in texts if MARK in t])), iter(found)
        return [next(rest) if MARK in t else next(known) for t in texts]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of many words by ``RULE``: joined by spaces, which only separate, and cut after end tokens."""
        found: list[bytes] = []
        for a in range(0, len(words), JOINED):
            part = words[a : a + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            data, cuts = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            found += [data[x:y] for x, y in zip([0, *cuts[:-1]], cuts, strict=True)] if len(cuts) == len(part) else self._direct(part)
        return found

    def _split(self, text: str) -> tuple[list[str], bool]:
        """The pieces of a text, and whether they are words by ``RULE``."""
        if self.ends is not None and MARK not in text and PLAIN.fullmatch(text):
            return WORD.findall(text.lower()), True
        return text.split(" "), False

    def _learn(self, cache: dict[str, bytes | None], pieces: set[str], lead: str, words: bool = False) -> list[str]:
        """Add unknown pieces to the cache; returns those to forget after the slice."""
        new = list(pieces.difference(cache))
        if self.spaces == "leading":
            good = [p for p in new if p and p.strip() == p]
            if len(good) < len(new):  # the others cannot be encoded alone
                cache.update(dict.fromkeys(set(new).difference(good)))
        else:
            good = new
        found = self._words(good) if words else self._pieces([lead + p for p in good])
        cache.update(zip(good, found, strict=True))
        room = max(0, CACHE_PIECES - len(cache) + len(new))
        return [p for i, p in enumerate(new) if i >= room or len(p) > CACHE_CHARS]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out: list[bytes] = []
        for a, b in slices(texts):
            out += self._slice(texts[a:b])
        return out

    def _slice(self, texts: Sequence[str]) -> list[bytes]:
        if self.spaces is None:
            return self._direct(list(texts))
        forget = []
        if self.spaces == "dropped":
            parted = [self._split(t) for t in texts]
            for words in (True, False):
                pieces = set().union(*(found for found, by_rule in parted if by_rule == words))
                forget.append((self.known, self._learn(self.known, pieces, "", words)))
            get = self.known.__getitem__
            out = [b"".join(map(get, pieces)) for pieces, _ in parted]
        else:
            split = [t.split(" ") for t in texts]
            forget.append((self.first, self._learn(self.first, {p[0] for p in split}, "")))
            forget.append((self.known, self._learn(self.known, set().union(*(p[1:] for p in split)), " ")))
            get, out = self.known.__getitem__, []
            for text, pieces in zip(texts, split, strict=True):
                try:
                    whole = b"".join((self.first[pieces[0]], *map(get, pieces[1:])))
                except TypeError:  # a piece that cannot be encoded alone has None
                    whole = self._direct([text])[0] if text else b""
                out.append(whole)
        for cache, pieces in forget:
            for piece in pieces:
                del cache[piece]
        return out


def _word_ends(tokenizer) -> np.ndarray | None:
    """Which ids end a word, for a tokenizer of lower-case words by ``RULE``; None for others."""
    told = json.loads(tokenizer.to_str())
    steps = [(s["type"], s.get("pattern"), s.get("content")) for s in (told["normalizer"] or {}).get("normalizers", ())]
    before = (told["pre_tokenizer"] or {}).get("pretokenizers", ())
    suffix = told["model"].get("end_of_word_suffix")
    same = (
        steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        and [s["type"] for s in before] == ["Split", "ByteLevel"]
        and (before[0]["pattern"], before[0]["behavior"], before[0]["invert"]) == ({"Regex": RULE}, "Removed", True)
        and (before[1]["add_prefix_space"], before[1]["use_regex"]) == (False, False)
        and told["post_processor"] is None
        and all(t["content"].startswith(MARK) for t in told["added_tokens"])
    )
    if not (same and suffix):
        return None
    ends = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
    ends[[i for token, i in told["model"]["vocab"].items() if token.endswith(suffix)]] = True
    return ends


def encoder(path: str, spaces: str | None) -> PieceEncoder:
    """The encoder of this worker for a tokenizer file, opened once."""
    key = (path, spaces)
    if key not in _OPEN:
        _OPEN[key] = PieceEncoder(path, spaces)
    return _OPEN[key]


_PUBLIC = re.compile(r"^public:(.+)$")


def local_path(name: str) -> str:
    """Path of a tokenizer file on this machine; ``public:NAME`` names an installed one.

    Resolved inside tasks, as the installed place may differ between machines.
    """
    if m := _PUBLIC.match(name):
        import public_tokenizers

        return str(public_tokenizers.path(m[1]))
    return name
