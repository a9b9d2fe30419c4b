"""Token ids of whole texts, with the ids of repeated words kept in a cache.

The result is exactly that of ``Tokenizer.encode(text, add_special_tokens=False)``:
a text is only cut where the tokenizer's own pre-tokenizer always cuts, and a text
without such a safe cut is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablestream.llm.common import only

#: Words whose ids a worker remembers; beyond, it keeps those of most batches.
CACHED_WORDS = 800_000
#: Fewer where a piece is a word by itself (420,000 took 265 MB of a worker): packing
#: comes last in the pipeline, when an executor has more workers than cores.
CACHED_BARE_WORDS = 250_000


class WordIds:
    """Ids of pieces of text: each piece has a slot, and a slot its ids in ``pool``.

    ``size`` is -1 for what is no safe piece. New pieces are encoded many at a time,
    with a mark between them that always gives one and the same id and is in none
    of them. ``letters``, if given, encodes words of nothing but letters; ``normal`` is
    what the tokenizer makes of a character before it looks for words.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[np.ndarray]],
        mark: str,
        piece: Callable[[str], str | None],
        most: int = CACHED_WORDS,
        letters: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None,
        normal: Callable[[str], str] = str,
    ) -> None:
        self.encode, self.mark, self.piece, self.most = encode, mark, piece, most
        self.letters = letters
        self.closed = lru_cache(4096)(lambda end: normal(end)[-1:].isalnum())
        self.mark_id = encode([mark])[0]
        self.joint = mark if mark.isspace() else f" {mark} "
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.pool, self.size, self.begin = (np.zeros(0, t) for t in ("<u4", np.int64, np.int64))
        # Whether a piece is glued to the one before, and ends in neither letter nor digit.
        self.glued, self.marked = np.zeros(0, bool), np.zeros(0, bool)
        # In how many batches a piece was; halved when others are forgotten.
        self.seen = np.zeros(0, np.int32)

    def of(self, words: list[str]) -> np.ndarray:
        """Slots of different words."""
        found = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        if len(new):
            if len(self.slot) > self.most:
                self.shrink()
                return self.of(words)
            missing = [words[i] for i in new.tolist()]
            self.add(missing)
            found[new] = np.fromiter(map(self.slot.__getitem__, missing), np.int64, len(new))
        self.seen[found] += 1
        return found

    def shrink(self) -> None:
        """Forget the words of one batch only, and all but half of ``most``."""
        kept = np.argsort(-self.seen, kind="stable")[: self.most // 2]
        kept = np.sort(kept[self.seen[kept] > 1])
        stays = np.zeros(len(self.slot), bool)
        stays[kept] = True
        words = list(compress(self.slot, stays.tolist()))
        self.slot = dict(zip(words, range(len(words)), strict=True))
        self.size = self.size[kept]
        held = np.maximum(self.size, 0)
        begin = np.cumsum(held) - held
        self.pool = self.pool[np.repeat(self.begin[kept] - begin, held) + np.arange(held.sum())]
        self.begin, self.seen = begin, self.seen[kept] // 2
        self.glued, self.marked = self.glued[kept], self.marked[kept]

    def add(self, words: list[str]) -> None:
        easy: list[str] = []
        if self.letters:
            only_letters = [m is not None for m in map(LETTERS.fullmatch, words)]
            easy = list(compress(words, only_letters))
            words = list(compress(words, [not x for x in only_letters]))
        plain, plain_words, odd, bad, parts = [], [], [], [], []
        for w in words:
            piece = self.piece(w)
            if piece is None:
                bad.append(w)
            elif self.mark in w or not w or w[0].isspace() or w[-1].isspace():
                odd.append(w)
                parts.append(piece)
            else:
                plain.append(piece)
                plain_words.append(w)
        ids = self.encode(parts)
        sizes = [np.array([len(x) for x in ids], np.int64)]
        if easy:
            easy_ids, easy_sizes = self.letters(easy)
            ids.insert(0, easy_ids)
            sizes.insert(0, easy_sizes)
        if plain:
            joined = self.encode([self.joint.join(plain)])[0]
            marks = joined == self.mark_id
            ends = np.append(np.flatnonzero(marks), len(joined))
            sizes.append(np.diff(ends, prepend=-1) - 1)
            ids.append(joined[~marks])
        good = np.concatenate(sizes)
        begin = len(self.pool) + np.cumsum(good) - good
        self.pool = np.concatenate([self.pool, *ids])
        self.size = np.concatenate([self.size, good, np.full(len(bad), -1)])
        self.begin = np.concatenate([self.begin, begin, np.zeros(len(bad), np.int64)])
        self.seen = np.append(self.seen, np.zeros(len(good) + len(bad), np.int32))
        rest = odd + plain_words + bad
        none = np.zeros(len(easy), bool)
        self.glued = np.concatenate([self.glued, none, np.array([w[:1] == GLUE for w in rest], bool)])
        marked = np.array([w != "" and not self.closed(w[-1]) for w in rest], bool)
        self.marked = np.concatenate([self.marked, none, marked])
        order = easy + rest
        first = len(self.slot)
        self.slot.update(zip(order, range(first, first + len(order)), strict=True))


#: In front of a piece that is cut off before a full stop or comma.
GLUE = "\x01"
#: Letters in every version of Unicode, which no normal form changes.
LETTERS = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
#: Characters with which a letter before them may become another one, and all beyond.
COMBINING = "[^\\x00-\\x{2FF}]"


def _behind_blank(word: str) -> str | None:
    """How a piece that was cut off before its blank, newline or stop is encoded.

    None where white space meets white space: the tokenizer may join both. Lines
    come as pieces with the newline in front.
    """
    bare = word[1:] if word[:1] in ("\n", GLUE) else word
    if not bare or bare[0].isspace() or bare[-1].isspace() or GLUE in bare:
        return None
    return bare if word[0] == GLUE else word if word[0] == "\n" else " " + word


def _bare(word: str) -> str | None:
    """How a piece is encoded whose tokenizer drops blanks."""
    bare = word.removeprefix(GLUE)
    return None if GLUE in bare else bare


def _byte_characters() -> np.ndarray:
    """The characters by which byte-level vocabularies write bytes; a newline stays."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printed]
    written = np.arange(256, dtype="<u2")
    written[others] = 256 + np.arange(len(others))
    written[ord("\n")] = ord("\n")
    return written


class Encoder:
    """Ids of texts as bytes: little-endian unsigned 32-bit."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(texts: list[str]) -> list[np.ndarray]:
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(x.ids, "<u4") for x in found]

        self.encode = encode
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.cut = _cut(config)
        self.tokenize = tokenizer.model.tokenize
        self.bytes = _byte_characters()
        self.added = [t["content"].lower() for t in config["added_tokens"]]
        self.lowers = "Lowercase" in str(config.get("normalizer"))
        letters = self.letters if _one_token_per_word(config) else None
        normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        if self.cut == "before blank":
            self.words = WordIds(encode, "\n", _behind_blank, CACHED_WORDS, letters, normal)
        elif self.cut == "at blank":
            # A letter may become one with a mark behind it, which stops are joined to.
            self.words = WordIds(encode, "0", _bare, CACHED_BARE_WORDS, letters, normal)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.encode(texts)]

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of ``LETTERS``, by the tokenizer's model.

        Such a word is one pre-token, so only case and bytes are left to do before.
        """
        joined = "\n".join(words)
        joined = joined.lower() if self.lowers else joined
        coded = np.frombuffer(joined.encode(), np.uint8)
        written = self.bytes[coded].tobytes().decode("utf-16-le")
        if self.cut == "before blank":
            blank = chr(self.bytes[ord(" ")])
            written = blank + written.replace("\n", "\n" + blank)
        pieces = written.split("\n")
        ids, sizes = [], []
        for a in range(0, len(pieces), 8192):
            found = list(map(self.tokenize, pieces[a : a + 8192]))
            sizes += map(len, found)
            ids.append(np.array([t.id for tokens in found for t in tokens], "<u4"))
        return np.concatenate(ids), np.array(sizes, np.int64)

    def lowered(self, texts: pa.Array) -> pa.Array:
        """A-Z in lower case, where the tokenizer does that anyway; texts stay that hold
        what it looks for before, or marks that it composes with letters before."""
        low = pc.ascii_lower(texts)
        stays = pc.match_substring_regex(texts, COMBINING)
        for token in self.added:
            stays = pc.or_(stays, pc.match_substring(low, token))
        return pc.if_else(stays, texts, low)

    def __call__(self, texts: list[str] | pa.Array) -> list[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if self.cut is None or not len(texts):
            return self.whole(texts.to_pylist())
        only(self.words)
        blanks = self.cut == "before blank"
        cut = self.lowered(texts) if self.lowers else texts
        cut = pc.replace_substring(cut, "\n", " \n" if blanks else " ")
        for stop in ",.":
            cut = pc.replace_substring(cut, stop, f" {GLUE}{stop}")
        split = pc.split_pattern(cut, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        index = coded.indices.to_numpy()
        slot = self.words.of(words.tolist())
        heads = bounds[:-1]
        # Stops next to other marks are one token with them.
        glued = np.flatnonzero(self.words.glued[slot][index])
        unsafe = glued[self.words.marked[slot][index[glued - 1]]]
        lost = set(_rows(np.setdiff1d(unsafe, heads), bounds))
        lost.update(np.flatnonzero(pc.match_substring(texts, GLUE)).tolist())
        size = self.words.size[slot]
        first = words[index[heads]].tolist() if blanks else None
        if blanks:
            # The first piece of a text has no blank before it: one of no ids instead.
            index = index.copy()
            index[heads] = len(slot)
            size = np.append(size, 0)
            slot = np.append(slot, 0)
        if (size < 0).any():
            lost.update(_rows(np.flatnonzero((size < 0)[index]), bounds))
            size = np.maximum(size, 0)
        ends = np.cumsum(size)
        at = np.repeat(self.words.begin[slot] - (ends - size), size) + np.arange(ends[-1])
        buffers = [np.append(0, ends * 4), self.words.pool[at]]
        ids = pa.Array.from_buffers(
            pa.large_binary(), len(size), [None, *map(pa.py_buffer, buffers)]
        ).take(pa.array(index))
        _, places, flat = ids.buffers()
        ends = np.frombuffer(places, np.int64, len(index) + 1)[bounds].tolist()
        flat = flat.to_pybytes() if flat else b""
        out = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        if blanks:
            # A text that starts with white space or a stop.
            lost.update(i for i, w in enumerate(first) if not w or w != w.strip() or GLUE in w)
            out = [a + b for a, b in zip(self.whole(first), out, strict=True)]
        for i in lost:
            out[i] = self.whole([texts[i].as_py()])[0]
        return out


def _rows(places: np.ndarray, bounds: np.ndarray) -> list[int]:
    """The texts to which the pieces at ``places`` belong."""
    return (np.searchsorted(bounds, places, "right") - 1).tolist()


def _cut(config: dict) -> str | None:
    """Where a text may be cut without a change of its tokens."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer")
    if any(t["lstrip"] or t["rstrip"] or {*t["content"]} & {*" .,"} for t in config["added_tokens"]):
        return None
    if (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex")
        and not pre.get("add_prefix_space")
        and norm is None
    ):
        # A blank before a non-blank starts a new pre-token, with the blank in it.
        return "before blank"
    steps = pre.get("pretokenizers", [])
    if (
        steps
        and steps[0].get("type") == "Split"
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and "[^\\s\\p{L}\\p{N}]+" in str(steps[0]["pattern"].get("Regex"))
        and {n["type"] for n in (norm or {}).get("normalizers", [])}
        <= {"NFC", "Replace", "Lowercase"}
    ):
        # White space is dropped and no token spans it.
        return "at blank"
    return None


def _one_token_per_word(config: dict) -> bool:
    """Whether ``LETTERS`` reach the byte-level model as one piece, lowered at most."""
    pre, norm = config.get("pre_tokenizer") or {}, config.get("normalizer") or {}
    if any(not {*t["content"]} - {*filter(str.isalpha, t["content"])} for t in config["added_tokens"]):
        return False
    if config["model"]["type"] != "BPE" or config["model"].get("dropout"):
        return False
    if pre.get("type") == "ByteLevel":
        return True
    *_, last = steps = pre.get("pretokenizers") or [{}]
    replaced = [n["pattern"] for n in norm.get("normalizers", []) if n["type"] == "Replace"]
    return (
        len(steps) == 2
        and steps[0].get("pattern") == {"Regex": CLIP}
        and (last.get("type"), last.get("use_regex"), last.get("add_prefix_space"))
        == ("ByteLevel", False, False)
        and replaced in ([], [{"Regex": r"\s+"}])
    )


CLIP = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(name: str) -> str:
    """A file of the public tokenizers installed beside Spark."""
    import public_tokenizers

    return public_tokenizers.path(name)
