"""Byte-pair encoding and decoding with a given vocabulary file."""

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Sequence

import regex
from pyspark.sql import DataFrame, SparkSession

from . import tokens
from .tokens import Remembered

# Unicode white space; what Python's str.split() takes for white space besides are four control characters.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = re.compile(f"[{_SPACE}]+")
_ODD_SPACE = re.compile("[\\x1c-\\x1f]")
# Letters and numbers, by first and last code point, that are younger than the Unicode tables of the
# tokenizers library, which therefore takes them for neither.
_YOUNG = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CF A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB "
    "11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 "
    "191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
# Young capitals that the library lower-cases, whether or not this Python knows them.
_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_CAPITALS |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable Latin-1, else the next one from U+0100."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[int, tuple[int, int]]) -> list[int]:
    """Merge neighbours, the lowest rank first and the leftmost of equal ranks, until no pair has a rank.

    ``ranks`` has (rank, merged symbol) for ``left << 20 | right``. The symbols are a doubly linked list; the
    queue keeps entries of pairs that have changed since, which are skipped when they come up.
    """
    n = len(symbols)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    queue = [(found[0], i) for i in range(n - 1) if (found := ranks.get(symbols[i] << 20 | symbols[i + 1]))]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        if symbols[i] < 0 or j < 0:
            continue
        found = ranks.get(symbols[i] << 20 | symbols[j])
        if found is None or found[0] != rank:
            continue
        symbols[i], symbols[j] = found[1], -1
        after[i] = j = after[j]
        if j >= 0:
            before[j] = i
            if found := ranks.get(symbols[i] << 20 | symbols[j]):
                heapq.heappush(queue, (found[0], i))
        h = before[i]
        if h >= 0 and (found := ranks.get(symbols[h] << 20 | symbols[i])):
            heapq.heappush(queue, (found[0], h))
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """What a tokenizer file says, for files of the kind of ``word_bpe_49k.json``: NFC and lower case, a pattern
    of words that drops the rest, letters for bytes, a suffix at word ends, special tokens found as they stand."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]] + [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or spec["model"]["type"] != "BPE" or spec["decoder"]:
            raise ValueError(f"{path} is a tokenizer of another kind")
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.merges: list[tuple[str, str]] = [tuple(m) for m in spec["model"]["merges"]]
        self.suffix: str = spec["model"]["end_of_word_suffix"]
        self.pattern: str = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special: dict[str, int] = {x["content"]: x["id"] for x in spec["added_tokens"]}


def word_pattern(pattern: str) -> regex.Pattern:
    """The file's pattern of words with the library's white space, letters and numbers."""
    young = "".join("-".join(f"\\U{int(c, 16):08X}" for c in span.split("-")) for span in _YOUNG.split())
    for kind in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(kind, f"[{kind}--[{young}]]")
    return regex.compile(pattern.replace("\\s", _SPACE), regex.V1)


class Codec:
    """Encodes and decodes as the tokenizers library does without added, truncated or padded tokens."""

    #: What decoding puts between vocabulary strings, and the end id, which this kind of file has none of.
    joint = b" "
    end = None

    def __init__(self, vocabulary: Vocabulary):
        ids, suffix = vocabulary.ids, vocabulary.suffix
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + suffix] for c in letters]
        self.ranks = {ids[a] << 20 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(vocabulary.merges)}
        self.words_of = word_pattern(vocabulary.pattern)
        # The same for ASCII, and faster.
        self.ascii_words = regex.compile(vocabulary.pattern.replace("\\s", _SPACE))
        self.special = vocabulary.special
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special))) + ")") if vocabulary.special else None
        self.strings = [""] * (max(*ids.values(), *vocabulary.special.values()) + 1)
        for table in (ids, vocabulary.special):
            for string, i in table.items():
                self.strings[i] = string
        self.data = [string.encode() for string in self.strings]
        self.of_part = Remembered(self._part, tokens.PARTS_REMEMBERED)
        self.of_word = Remembered(self._word, tokens.WORDS_REMEMBERED)

    def _part(self, part: str) -> bytes:
        data = part.encode()
        return array("i", merge([*(self.inner[b] for b in data[:-1]), self.last[data[-1]]], self.ranks)).tobytes()

    def _word(self, word: str) -> bytes:
        found: list[bytes] = []
        for stretch in self.split.split(word) if self.split else [word]:
            if stretch in self.special:
                found.append(array("i", [self.special[stretch]]).tobytes())
                continue
            # Letter by letter: a sigma at the end of a word has no form of its own here.
            lower = unicodedata.normalize("NFC", stretch).replace("Σ", "σ").lower()
            parts = self.ascii_words.findall(lower) if lower.isascii() else self.words_of.findall(lower.translate(_CAPITALS))
            found.extend(map(self.of_part.__getitem__, parts))
        return b"".join(found)

    def words(self, text: str) -> list[str]:
        """No part that the pattern finds holds white space, so what is between is encoded by itself."""
        return _SPACES.split(text) if _ODD_SPACE.search(text) else text.split()

    def encode(self, text: str | None) -> list[int]:
        return array("i", b"".join(map(self.of_word.__getitem__, self.words(text))) if text else b"").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary strings joined by a space, as this kind of file, which names no decoder, has it."""
        return " ".join(map(self.strings.__getitem__, ids))

    def finished(self, first: int | None, data: bytes) -> str:
        """The text of the joined vocabulary strings."""
        return data.decode()


class Bpe(tokens.OnSpark):
    """The codec on Spark: the driver reads the file, tasks get its tables (some 50,000 entries) by broadcast, and a
    worker keeps the codec, with the words that it remembers, for all of its tasks."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(("bpe", tokens.digest(path)), spark.sparkContext.broadcast(Vocabulary(path)), Codec)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (only the columns ``keep``, if given) with n_tokens and token_ids; columns of those names are replaced.

    Every whole text is encoded; null and empty texts have no tokens. Repeated rows come out each; an empty
    table gives no rows. Nothing is shuffled. Tasks hand on the ids of some hundred documents at a time.
    """
    return tokens.encoded(docs, Bpe(docs.sparkSession, path).codec, text, keep)


def with_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of every whole text, see ``tokens.with_digests``."""
    return tokens.with_digests(docs, Bpe(docs.sparkSession, path).codec, text)
