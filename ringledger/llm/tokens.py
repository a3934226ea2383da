"""Token ids of whole texts with a public tokenizer file, computed once per distinct word."""

from __future__ import annotations

import os
from itertools import chain, compress

import numpy as np

from ringledger.llm.words import FEW_WORDS, Vocabulary

#: Pieces encoded at once. More take no less time, and all that the tokenizer says of them.
BLOCK = 1024
#: What the file's model puts at the end of the last token of a word.
_WORD_END = "</w>"
#: What the file's pre-tokenizer splits off after a letter or digit, in ASCII.
_TAIL = b",.;:!?"
_ENDS = b".!?"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where a file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space and never joins across it.

    So ids of a text are those of its words in turn. Words differ from each other mostly
    by capitals and final punctuation, which this tokenizer lowers and splits off anyway;
    so that is done first, and what is left is encoded once.
    """

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        tokens = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(tokens.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in tokens.items() if token.endswith(_WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.vocabulary = Vocabulary(FEW_WORDS)
        self.counts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.offsets = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.ends = np.zeros(0, bool)
        self._clear_pieces()

    def _clear_pieces(self) -> None:
        # Words fall into two pieces each, of which there are far fewer.
        self.pieces = Vocabulary(FEW_WORDS)
        self.piece_lengths = np.zeros(0, np.int64)
        self.piece_offsets = np.zeros(0, np.int64)
        self.piece_flat = np.zeros(0, np.uint32)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text starts in them (and the end), and where sentences end."""
        if self.vocabulary.full:
            self._make_room()
        words, starts = self.vocabulary.number(texts)
        more = np.bincount(words, minlength=len(self.vocabulary.words))
        more[: len(self.counts)] += self.counts
        self.counts = more
        self._learn(self.vocabulary.words[len(self.lengths) :])
        lengths = self.lengths[words]
        ids = self.flat[_runs(self.offsets[words], lengths)]
        after = np.cumsum(lengths)
        bounds = np.r_[0, after][starts]
        return ids, bounds, np.unique(after[self.ends[words]])

    def _make_room(self) -> None:
        """Keep the frequent words only, and start the pieces anew if they are many as well."""
        often = self.vocabulary.frequent(self.counts)
        self.vocabulary, self.counts = self.vocabulary.only(often), self.counts[often]
        self.flat = self.flat[_runs(self.offsets[often], self.lengths[often])]
        self.lengths, self.ends = self.lengths[often], self.ends[often]
        self.offsets = np.cumsum(self.lengths) - self.lengths
        if self.pieces.full:
            self._clear_pieces()

    def _learn(self, words: list[bytes]) -> None:
        if not words:
            return
        number = self.pieces.__getitem__
        stems, tails = _parts(words)
        pairs = np.empty((len(words), 2), np.int64)
        pairs[:, 0] = np.fromiter(map(number, stems), np.int64, len(words))
        pairs[:, 1] = np.fromiter(map(number, tails), np.int64, len(words))
        self._learn_pieces(self.pieces.words[len(self.piece_lengths) :])
        each = self.piece_lengths[pairs]
        flat = self.piece_flat[_runs(self.piece_offsets[pairs.ravel()], each.ravel())]
        lengths = each.sum(axis=1)
        self.offsets = np.r_[self.offsets, len(self.flat) + np.cumsum(lengths) - lengths]
        self.lengths = np.r_[self.lengths, lengths]
        self.flat = np.r_[self.flat, flat]
        self.ends = np.r_[self.ends, _ENDING[_last(words)]]

    def _learn_pieces(self, pieces: list[bytes]) -> None:
        if not pieces:
            return
        blocks = [self._encoded(pieces[i : i + BLOCK]) for i in range(0, len(pieces), BLOCK)]
        flat, lengths = (np.concatenate(x) for x in zip(*blocks))
        offsets = len(self.piece_flat) + np.cumsum(lengths) - lengths
        self.piece_offsets = np.r_[self.piece_offsets, offsets]
        self.piece_lengths = np.r_[self.piece_lengths, lengths]
        self.piece_flat = np.r_[self.piece_flat, flat]

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in turn, and how many each has.

        Pieces of letters only are one word each, so they go as one text, in which the marks of
        words' ends tell them apart. If these are not as many as the pieces, a letter was
        split or left out, and each piece is encoded by itself.
        """
        texts = [piece.decode("utf-8", "replace") for piece in pieces]
        letters = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        words = list(compress(texts, letters.tolist()))
        whole = np.array(self._each([" ".join(words)])[0], np.uint32)
        last = np.flatnonzero(self.ends_word[whole])
        if len(last) != len(words) or (len(last) and last[-1] != len(whole) - 1):
            letters[:] = False
        others = self._each(list(compress(texts, (~letters).tolist())))
        lengths = np.zeros(len(texts), np.int64)
        lengths[~letters] = np.fromiter(map(len, others), np.int64, len(others))
        if letters.any():
            lengths[letters] = np.diff(last, prepend=-1)
        flat = np.zeros(int(lengths.sum()), np.uint32)
        own = np.repeat(letters, lengths)
        flat[~own] = np.fromiter(chain.from_iterable(others), np.uint32, int((~own).sum()))
        if letters.any():
            flat[own] = whole
        return flat, lengths

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _runs(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``offsets[i], offsets[i] + 1, ...`` of all runs in turn."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(offsets - before, lengths) + np.arange(int(lengths.sum()))


def _last(words: list[bytes]) -> np.ndarray:
    """The last byte of each word, 0 for an empty one."""
    return np.frombuffer(b"".join([word[-1:] or b"\0" for word in words]), np.uint8)


def _among(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_ENDING = _among(_ENDS)
_ALNUM = _among(bytes(c for c in range(128) if chr(c).isalnum()))


def _parts(words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """The words in lower case and their final punctuation, where that changes no id."""
    joined = b"\n".join(words)  # there is no line end in a word
    low = joined.lower().split(b"\n")
    stems = [word.rstrip(_TAIL) for word in low]
    last = _last(stems)
    for i in np.flatnonzero(~_ALNUM[last]).tolist():  # a letter beyond ASCII, or no letter
        if last[i] < 128 or not stems[i].decode("utf-8", "replace")[-1:].isalpha():
            stems[i] = low[i]
    if b"<|" in joined:
        for i, word in enumerate(words):
            if b"<|" in word:  # the names of special tokens keep their case
                low[i] = stems[i] = word
    return stems, [word[len(stem) :] for word, stem in zip(low, stems)]
