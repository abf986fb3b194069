"""Byte-pair ids of whole texts, word by word, and token counts at every prefix."""

from __future__ import annotations

import functools
import itertools
import json
from array import array
from collections.abc import Callable, Iterator

import regex
from tokenizers import Tokenizer

#: White space and the splitting pattern of byte-level BPE vocabularies.
SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Words whose ids a worker keeps; beyond it the kept ones are forgotten.
KEPT_WORDS = 700_000


class _Memory(dict):
    """Computes missing values; forgets all of them when there are too many."""

    def __init__(self, compute: Callable[[str], object], limit: int):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, key: str):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._compute(key)
        return value


class Encoder:
    """Ids of whole texts as the vocabulary's library gives them, without added tokens.

    Texts are cut where the vocabulary's pattern always cuts (before a single blank, around a
    single line feed), and the library encodes each distinct piece once.  A text with longer runs
    of white space is split by the pattern itself.
    """

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self._specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known = "|".join(regex.escape(s) for s in sorted(self._specials, key=len, reverse=True))
        self._special = regex.compile(f"({known})") if known else None
        self.split = regex.compile(SPLIT)
        self._plain = _Memory(lambda w: self._encode(w), kept_words)
        self._spaced = _Memory(lambda w: self._encode(" " + w), kept_words)
        self._break = self._encode("\n")

    def _encode(self, piece: str) -> bytes:
        return array("I", self._library.encode(piece, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as unsigned 32-bit little-endian integers."""
        if self._special is not None and any(s in text for s in self._specials):
            parts = self._special.split(text)
            return b"".join(
                self._ids(part) if i % 2 == 0 else array("I", [self._specials[part]]).tobytes()
                for i, part in enumerate(parts)
            )
        return self._ids(text)

    def _ids(self, text: str) -> bytes:
        if not single_gaps(text):
            return b"".join(map(self._plain.__getitem__, self.split.findall(text)))
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self._plain[first] + b"".join(map(self._spaced.__getitem__, rest)))
        return self._break.join(lines)

    def sizes(self, text: str) -> tuple[list[int], list[int]]:
        """Code points and tokens of consecutive pieces, each cut where the pattern always cuts."""
        special = self._special is not None and any(s in text for s in self._specials)
        if special or not single_gaps(text):
            pieces = [(len(piece), len(ids) // 4) for piece, ids in self.pieces(text)]
            return [n for n, _ in pieces], [n for _, n in pieces]
        chars, tokens = [], []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            chars.append(len(first))
            chars.extend([len(word) + 1 for word in rest])
            chars.append(1)
            tokens.append(len(self._plain[first]) // 4)
            tokens.extend([len(ids) // 4 for ids in map(self._spaced.__getitem__, rest)])
            tokens.append(len(self._break) // 4)
        return chars[:-1], tokens[:-1]

    def is_special(self, piece: str) -> bool:
        return piece in self._specials

    def pieces(self, text: str) -> Iterator[tuple[str, bytes]]:
        """The pieces in which the pattern (or a special string) cuts a text, with their ids."""
        parts = self._special.split(text) if self._special is not None else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield part, array("I", [self._specials[part]]).tobytes()
            else:
                for piece in self.split.findall(part):
                    yield piece, self._plain[piece]


def single_gaps(text: str) -> bool:
    """Whether a text has words and, between any two of them, one blank or one line feed."""
    words = text.split()
    gaps = len(words) - 1
    return (
        gaps >= 0
        and text.count(" ") + text.count("\n") == gaps
        and sum(map(len, words)) + gaps == len(text)
    )


class PrefixCounts:
    """Token counts of every prefix of a word, by dynamic programming over its bytes.

    The encoding of a byte string is the only sequence of tokens in which every token encodes to
    itself and every neighbouring pair of tokens encodes to just that pair.  So the encoding of a
    prefix is that of a shorter prefix plus one token that fits the shorter one's last token: one
    pass from left to right gives last token and count of all prefixes.
    """

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        letters = _byte_letters()
        back = {c: bytes([b]) for b, c in letters.items()}
        spelled = {t: b"".join(back[c] for c in t) for t in model["vocab"] if all(map(back.get, t))}
        self._tokens = set(spelled.values())
        self._longest = max(map(len, self._tokens))
        self._rank = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self._rank.setdefault((spelled[left], spelled[right]), rank)
        self.alone = functools.lru_cache(200_000)(lambda token: self._merged(token) == [token])
        self.fits = functools.lru_cache(500_000)(lambda a, b: self._merged(a + b) == [a, b])

    def _merged(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranks = [self._rank.get(pair, 1 << 60) for pair in itertools.pairwise(parts)]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def of_bytes(self, word: bytes) -> list[int]:
        """Counts for the prefixes of 0, 1, ... len(word) bytes."""
        counts, last = [0], [b""]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - self._longest), end):
                token = word[start:end]
                if token in self._tokens and (
                    self.fits(last[start], token) if start else self.alone(token)
                ):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no encoding: {word[:end]!r}")
        return counts

    def of_text(self, word: str) -> list[int]:
        """Counts for the prefixes of 0, 1, ... len(word) code points."""
        by_byte = self.of_bytes(word.encode())
        ends = itertools.accumulate(len(c.encode()) for c in word)
        return [0, *(by_byte[e] for e in ends)]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@functools.lru_cache(4)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file."""
    return Encoder(path)


@functools.lru_cache(4)
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(path)
