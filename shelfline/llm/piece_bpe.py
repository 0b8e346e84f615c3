"""Encoding and decoding with a sentencepiece vocabulary of the merge type, by backtracking over longest matches."""

import codecs
import re
import struct
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from . import tokens
from .bpe import merge
from .tokens import Remembered

#: The mark that stands for a space.
SPACE = "▁"
# Field numbers and kinds of pieces in a model file.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGE_TYPE = 2

_SPACED = re.compile(f"{SPACE}+[^{SPACE}]*")
# One mark of replacement for each byte.
codecs.register_error("piece_bpe", lambda fault: ("�", fault.start + 1))


def _fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """(number, value) of every field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = number() if key & 7 == 2 else {5: 4, 1: 8}[key & 7]
        value = data[at : at + size]
        at += size
        yield key >> 3, struct.unpack("<f", value)[0] if key & 7 == 5 else value


class Vocabulary:
    """What a model file says: of the merge type, with bytes for unknown characters, and a space before the text.

    ``ranks`` has (rank, merged piece) for ``left << 20 | right``, equal scores having equal ranks. ``whole`` are the
    pieces that merging makes of their own string; no other can occur in an encoded text.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        trainer, normalizer = (dict(_fields(next(v for f, v in model if f == part))) for part in (_TRAINER, _NORMALIZER))
        pieces = [dict(_fields(v)) for f, v in model if f == _PIECES]
        kinds = [p.get(3, _NORMAL) for p in pieces]
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1) and not trainer.get(24, 0)
        if trainer.get(3) != _MERGE_TYPE or not trainer.get(35) or not plain or not set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError(f"{path} is a model of another kind")
        self.strings = [p[1].decode() for p in pieces]
        self.kinds = kinds
        normal = {self.strings[i]: i for i, kind in enumerate(kinds) if kind == _NORMAL}
        self.ids, self.letters = normal, {s: i for s, i in normal.items() if len(s) == 1}
        if any(c not in self.letters for s in normal for c in s):
            raise ValueError(f"{path} has pieces of characters that it does not have")
        self.bytes = [i for i, kind in enumerate(kinds) if kind == _BYTE]
        if [self.strings[i] for i in self.bytes] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError(f"{path} does not have all bytes, in order")
        self.end = self.strings.index("</s>") if "</s>" in self.strings else None
        places = {score: rank for rank, score in enumerate(sorted({pieces[i][2] for i in normal.values()}, reverse=True))}
        self.ranks = {
            normal[s[:k]] << 20 | normal[s[k:]]: (places[pieces[i][2]], i)
            for s, i in normal.items()
            for k in range(1, len(s))
            if s[:k] in normal and s[k:] in normal
        }
        self.whole = [i for s, i in normal.items() if merge([self.letters[c] for c in s], self.ranks) == [i]]
        #: Of every such piece the rank, left and right part of its last merge; letters have rank -1.
        self.made = {i: self._last_merge(self.strings[i]) for i in self.whole}
        if any(max(self.made[a][0], self.made[b][0]) > rank for rank, a, b in self.made.values() if rank >= 0):
            raise ValueError(f"{path} has pieces whose parts are merged after them")

    def _last_merge(self, string: str) -> tuple[int, int, int]:
        """What merging leaves of the piece's string if it may not make the piece itself are its two parts."""
        if len(string) == 1:
            return -1, 0, 0
        piece = self.ids[string]
        left, right = merge([self.letters[c] for c in string], _Without(self.ranks, piece))
        return self.ranks[left << 20 | right][0], left, right


class _Without:
    def __init__(self, ranks: dict[int, tuple[int, int]], piece: int):
        self.ranks, self.piece = ranks, piece

    def get(self, pair: int) -> tuple[int, int] | None:
        found = self.ranks.get(pair)
        return None if found is None or found[1] == self.piece else found


class Codec:
    """Encodes and decodes as the sentencepiece library does without sampling.

    Pieces are taken from the left, the longest first; a piece may follow another if merging the string of both
    gives these two, and pieces that fit pairwise are what merging gives for the whole text. Where none may follow,
    the position is marked as failed, and the piece before it gets shorter.
    """

    #: What decoding puts between the strings of pieces.
    joint = b""

    def __init__(self, vocabulary: Vocabulary, end: bool = False):
        self.strings, self.ranks, self.letters = vocabulary.strings, vocabulary.ranks, vocabulary.letters
        self.end, self.byte_ids = vocabulary.end if end else None, vocabulary.bytes
        self.lengths = list(map(len, self.strings))
        self.whole, self.made = frozenset(vocabulary.whole), vocabulary.made
        whole = {self.strings[i]: i for i in vocabulary.whole}
        #: The longest piece that is a shorter beginning of a piece, or 0.
        self.shorter = [0] * len(self.strings)
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for s, i in whole.items():
            if len(s) > 1:
                self.matches.add_word(s, i)
            self.shorter[i] = next((whole[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in whole), 0)
        self.matches.make_automaton()
        self._parts()
        self.data = [b"" if kind == _CONTROL else s.replace(SPACE, " ").encode() for s, kind in zip(self.strings, vocabulary.kinds)]
        for i, kind in enumerate(vocabulary.kinds):
            if kind == _UNKNOWN:
                self.data[i] = " ⁇ ".encode()
        for byte, i in enumerate(self.byte_ids):
            self.data[i] = bytes([byte])
        self.unseen = {i for i, kind in enumerate(vocabulary.kinds) if kind == _CONTROL}
        self.fits = Remembered(self._fits, tokens.PARTS_REMEMBERED)
        self.of_part = Remembered(self._part, tokens.PARTS_REMEMBERED)
        self.of_word = Remembered(self._word, tokens.WORDS_REMEMBERED)

    def _parts(self) -> None:
        """Where a text can be cut, as no piece goes across: before a space after another character, around unknown
        characters, and after the characters that no piece has before any but their like (most letters)."""
        pairs = {s[k : k + 2] for s, i in zip(self.strings, range(len(self.strings))) if i in self.whole for k in range(len(s) - 1)}
        self.spaces_cut = not any(b == SPACE != a for a, b in pairs)
        like = {c for c in self.letters if c.isalpha()}
        while odd := {a for a, b in pairs if a in like and b not in like}:
            like -= odd
        ends = re.escape("".join(like))
        known = re.escape("".join(c for c in self.letters if c not in like and c != SPACE))
        if self.spaces_cut:
            self.cut = re.compile(f"{SPACE}*[{known}]*[{ends}]+|{SPACE}+[{known}]*|[{known}]+|[^{SPACE}{known}{ends}]")
        else:
            self.cut = re.compile(f"[{SPACE}{known}]*[{ends}]+|[{SPACE}{known}]+|[^{SPACE}{known}{ends}]")

    def _fits(self, pair: int) -> bool:
        """Whether no merge goes across the border of two pieces: their last merges are undone, the latest first, and
        what then meets at the border must not merge before the merge that was undone."""
        left, right = pair >> 20, pair & 0xFFFFF
        if not left:
            return True
        ranks, made, limit = self.ranks, self.made, len(self.ranks)
        while True:
            found = ranks.get(left << 20 | right)
            if found and found[0] < limit:
                return False
            if made[left][0] > made[right][0]:
                limit, _, left = made[left]
            elif made[right][0] < 0:
                return True
            else:
                # Of equal ranks the left merge comes first, so the border's may have the same.
                limit, right, _ = made[right]
                limit += 1

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.of_part.__getitem__, self.cut.findall(word)))

    def _part(self, part: str) -> bytes:
        ids = self.backtrack(part) if part[0] in self.letters else [self.byte_ids[b] for b in part.encode()]
        return array("i", ids).tobytes()

    def backtrack(self, part: str) -> list[int]:
        """The pieces of a string of known characters."""
        n, lengths, shorter, fits = len(part), self.lengths, self.shorter, self.fits
        longest = list(map(self.letters.__getitem__, part))
        # Matches come in the order of their ends, so the last one noted for a start is the longest.
        for last, piece in self.matches.iter(part):
            longest[last + 1 - lengths[piece]] = piece
        failed, some_failed = bytearray((n >> 3) + 1), False
        found: list[int] = []
        at = before = 0
        piece = longest[0]
        while True:
            end = at + lengths[piece]
            if (not some_failed or not failed[end >> 3] >> (end & 7) & 1) and fits[before << 20 | piece]:
                found.append(piece)
                if end == n:
                    return found
                at, before, piece = end, piece, longest[end]
            elif shorter[piece]:
                piece = shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                some_failed = True
                piece = found.pop()
                at -= lengths[piece]
                before = found[-1] if found else 0

    def words(self, text: str) -> list[str]:
        """The text cut before spaces that follow another character; the spaces are marks, one comes before the text."""
        if not self.spaces_cut:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or SPACE in text or text[0] == " ":
            return _SPACED.findall(SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE)).split(" ")

    def encode(self, text: str | None) -> list[int]:
        """The ids of the whole text, with the end id if the codec has one."""
        found = array("i", b"".join(map(self.of_word.__getitem__, self.words(text))) if text else b"").tolist()
        return found if self.end is None else [*found, self.end]

    def decode(self, ids: Iterable[int]) -> str:
        """The strings of the pieces, one after another, without the space before the text; bytes that are no
        character become U+FFFD each."""
        ids = list(ids)
        seen = next((i for i in ids if i not in self.unseen), None)
        return self.finished(seen, b"".join(map(self.data.__getitem__, ids)))

    def finished(self, first: int | None, data: bytes) -> str:
        """The text of the joined strings of pieces, ``first`` being the first that is no control piece."""
        if first is not None and self.strings[first].startswith(SPACE):
            data = data[1:]
        return data.decode("utf-8", "piece_bpe")


class PieceBpe(tokens.OnSpark):
    """The codec on Spark: the driver reads the file, tasks get its tables (some 100,000 entries) by broadcast, and a
    worker keeps the codec, with the words that it remembers, for all of its tasks.

    With ``end``, every text, also a null or empty one, ends by the end id of the vocabulary.
    """

    def __init__(self, spark: SparkSession, path: str, end: bool = False):
        vocabulary = Vocabulary(path)
        if end and vocabulary.end is None:
            raise ValueError(f"{path} has no end id")
        super().__init__(("piece_bpe", tokens.digest(path), end), spark.sparkContext.broadcast(vocabulary), partial(Codec, end=end))


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, end: bool = True) -> DataFrame:
    """``docs`` (only the columns ``keep``, if given) with n_tokens and token_ids; columns of those names are replaced.

    Every whole text is encoded, a null one as the empty one. Repeated rows come out each; an empty table gives no
    rows. Nothing is shuffled.
    """
    return tokens.encoded(docs, PieceBpe(docs.sparkSession, path, end).codec, text, keep)


def with_digests(docs: DataFrame, path: str, text: str = "text", end: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of every whole text, see ``tokens.with_digests``."""
    return tokens.with_digests(docs, PieceBpe(docs.sparkSession, path, end).codec, text)
