"""Subword ids of many words at once: every distinct word goes through the tokenizer a single time.

The word tokenizer drops white space and never joins across it, so a text's ids are those of its
words (runs without ASCII white space) in a row. That holds for normalization too: white space
composes with nothing.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

#: Words a task remembers before it starts anew.
KNOWN_WORDS = 1_000_000


def word_tokenizer(path: str | None):
    """The tokenizer of a file; by default the public word tokenizer."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Words that go through the tokenizer as one text.
TOGETHER = 500


def encode_words(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and the number of ids of each.

    Words are encoded with blanks between them, which costs a third of encoding each on its own; the
    place of an id in that text tells its word.
    """
    runs = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
    ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    for run, found in zip(runs, tokenizer.encode_batch([" ".join(r) for r in runs], add_special_tokens=False)):
        ids.append(np.array(found.ids, np.uint32))
        starts = np.cumsum([0, *(len(w) + 1 for w in run)])
        at = np.fromiter(chain.from_iterable(found.offsets), np.int64)[::2]
        sizes.append(np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(run)))
    return np.concatenate(ids), np.concatenate(sizes)


def gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ids of the words ``which``, one after the other."""
    size = sizes[which]
    ends = np.cumsum(size)
    shift = np.repeat(starts[which] - (ends - size), size)
    return ids[shift + np.arange(len(shift))]


class KnownWords:
    """Words a task has met, with their ids."""

    def __init__(self, path: str | None):
        self.tokenizer = word_tokenizer(path)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def encode(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of ``flat`` in a row, and the number of ids of each."""
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.place) + len(names) > KNOWN_WORDS:
            self.clear()
        new = [w for w in names if w not in self.place]
        if new:
            ids, sizes = encode_words(self.tokenizer, new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.ids = np.concatenate([self.ids, ids])
            self.sizes = np.concatenate([self.sizes, sizes])
        place = np.fromiter(map(self.place.__getitem__, names), np.int64, len(names))
        which = place[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else place[:0]
        starts = np.cumsum(self.sizes) - self.sizes
        return gathered(self.ids, starts, self.sizes, which), self.sizes[which]
