"""Texts to token ids with the ``tokenizers`` library, a word at a time through a cache.

Byte-level BPE never merges across the runs of letters, digits and marks that its rule cuts a text
into, so a text of ASCII, Latin letters and common marks is cut into its runs and each run is encoded
once per worker. Texts with other characters are cut at single spaces only; pieces next to other white
space, and texts that hold a special token, are encoded as whole texts instead.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Callable
from functools import cache

CACHE_PIECES = 250_000
NEWLINE_ID = 198
JOINED = 50
MARKS = ".,;:!?"
BESIDE_SPACE = b"beside white space"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
COMMON_MARKS = "!-/:-@\\[-`{-~¡-©«-¬®-±´¶-¸»¿×÷‐-‧‰-⁞€"
# The byte-level rule for these characters; what it leaves out does not match.
RUNS = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{LATIN}]+| ?[0-9]+| ?[{COMMON_MARKS}]+|\n(?=\\S)")
# Byte-level vocabularies write a byte as a letter: printable ones as themselves, the others from 256 up.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
LETTER_OF_BYTE = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
PROBE = "It's 'tis  no_one's! (naïve) 12.5km²\n«Łódź»... they'll\nx 'd?'s ßtraße—100% €5,\tand\n\n a"


class Runs(dict):
    """Ids of runs; a new run's are taken from the older generation or else worked out."""

    def __init__(self, encode: Callable[[str], bytes], old: dict[str, bytes]):
        self.encode, self.old = encode, old

    def __missing__(self, run: str) -> bytes:
        ids = self[run] = self.old.get(run) or self.encode(run)
        return ids


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    The caches of pieces and runs have two generations of ``CACHE_PIECES`` together, so memory is bounded.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.runs = Runs(self._run_ids, {})
        self.model = self.tokenizer.model
        self.cuts_runs = self._cuts_runs()
        # A mark after a letter opens a new piece of the merge rules.
        self.marks = dict(zip(MARKS, self.whole(list(MARKS))))

    def whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in done]

    def _cuts_runs(self) -> bool:
        """Whether this vocabulary cuts a text as ``RUNS`` does, and encodes a run byte by byte."""
        rule = self.tokenizer.pre_tokenizer
        if rule is None or self.tokenizer.normalizer is not None:
            return False
        runs = RUNS.findall(PROBE)
        theirs = {PROBE[a:b] for _, (a, b) in rule.pre_tokenize_str(PROBE)}
        return theirs - set(runs) == {" ", "²", "\t", "\n\n"} and [self._run_ids(r) for r in runs] == self.whole(runs)

    def _learn(self, pieces: set[str]) -> None:
        """Encode unseen pieces, joined by newlines so that one call serves many."""
        import numpy as np

        odd, plain = [], []
        for p in pieces:
            if not p or p[-1].isspace() or p[0] == " " and p[1:2].isspace() or p[0] != " " and p[0].isspace():
                self.new[p] = BESIDE_SPACE
            elif p[0] == " " and len(p.split()) == 1:
                plain.append(p)
            else:
                odd.append(p)
        for at in range(0, len(plain), JOINED):
            some = plain[at:at + JOINED]
            ids = np.asarray(self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == NEWLINE_ID).tolist()
            if len(ends) != len(some) - 1:  # a vocabulary with another newline
                odd.extend(some)
                continue
            data, begin = ids.tobytes(), 0
            for p, end in zip(some, [*ends, len(ids)]):
                self.new[p] = data[begin:4 * end]
                begin = 4 * end + 4
        self.new.update(zip(odd, self.whole(odd)))

    def _run_ids(self, run: str) -> bytes:
        """Ids of a run: the model takes it as it is, so the rule need not cut it again."""
        held = self.model.tokenize(run.encode().decode("latin-1").translate(LETTER_OF_BYTE))
        return struct.pack(f"<{len(held)}I", *[t.id for t in held])

    def _known(self, piece: str) -> bytes | None:
        """Ids of a piece from the older cache, or of a known word and the mark that ends it."""
        if (ids := self.old.get(piece)) is None and piece[-1:] in self.marks and piece[-2:-1].isalpha():
            word = piece[:-1]
            if (ids := self.new.get(word) or self.old.get(word)) == BESIDE_SPACE:
                ids = None  # no ids to lend: ``_learn`` marks the piece too
            if ids is not None:
                ids += self.marks[piece[-1]]
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.new) + len(self.runs) > CACHE_PIECES:
            self.old, self.new = self.new, {}
            self.runs.old = {}  # two generations, no chain of them
            self.runs = Runs(self._run_ids, self.runs)
        known = self.new
        out: list = [b""] * len(texts)
        cut: list[tuple[int, list[str]]] = []
        unseen: set[str] = set()
        whole = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if "\0" in text or any(s in text for s in self.special):
                whole.append(i)
                continue
            if self.cuts_runs and "".join(runs := RUNS.findall(text)) == text:
                out[i] = b"".join(map(self.runs.__getitem__, runs))
                continue
            # Every piece but the first keeps the space that opens it.
            pieces = text.replace(" ", "\0 ").split("\0")
            cut.append((i, pieces))
            unseen.update(itertools.filterfalse(known.__contains__, pieces))
        if unseen:
            for p in list(unseen):
                if (ids := self._known(p)) is not None:
                    known[p] = ids
                    unseen.discard(p)
            self._learn(unseen)
        for i, pieces in cut:
            found = list(map(known.__getitem__, pieces))
            if BESIDE_SPACE in found:
                whole.append(i)
            else:
                out[i] = b"".join(found)
        for i, ids in zip(whole, self.whole([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        return out


@cache
def encoder(vocabulary: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(vocabulary)


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
