"""Text to token ids by distinct, blank-separated stretches; the encoder of pre-split words is pluggable."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed values of the byte-level vocabulary: white space, the split before merges, and the end-of-text string.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{SPACE}\\p{{L}}\\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
END_OF_TEXT, END_OF_TEXT_ID = "<|endoftext|>", 50256

#: Two touching white-space characters, or a zero byte: such texts are split as a whole.
_ODD = r"[\t-\r\x1c-\x20\x{85}\p{Z}][\t-\r\x1c-\x20\x{85}\p{Z}]|\x00"
#: The first stretch or not, a line end or not, letters, and a mark or not that is a pre-split word of its own.
_SIMPLE = r"^[\x00\n]?\p{L}+[.,;:?]?$"


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of values that begin at starts, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat((starts - ends + sizes).astype(np.int64), sizes)
    at += np.arange(total)
    return values[at]


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4 << 20, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text (or one row)."""
    sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
    at = 0
    while at < batch.num_rows:
        till = max(at + 1, min(at + most_rows, int(np.searchsorted(sizes, sizes[at] + most_bytes, "right")) - 1))
        yield batch.slice(at, till - at)
        at = till


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and how many each has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]], np.diff(offsets).astype(np.int64)


class TextEncoder:
    """ids(texts): little-endian unsigned 32-bit ids of each text, as bytes; null texts have none.

    A blank between two characters that aren't white space starts a pre-split word, so a text without two touching
    white-space characters is cut at its blanks, and each distinct stretch of a batch is split and encoded once. Other
    texts are split as a whole. encode_many(bytes of all words, bytes a word) -> (all ids, ids a word).
    """

    def __init__(self, encode_many: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], special: bool = True):
        self.encode_many, self.special = encode_many, special

    def ids(self, texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        odd = pc.match_substring_regex(texts, _ODD)
        if self.special:
            odd = pc.or_(odd, pc.match_substring(texts, END_OF_TEXT))
        out: list[bytes] = [b""] * len(texts)
        is_odd = odd.to_numpy(zero_copy_only=False)
        for rows, found in ((np.flatnonzero(~is_odd), self._plain), (np.flatnonzero(is_odd), self._whole)):
            if rows.size:
                values, sizes = found(texts.take(pa.array(rows)))
                data = values.astype("<u4").tobytes()
                ends = 4 * np.cumsum(sizes)
                for row, a, b in zip(rows.tolist(), (ends - 4 * sizes).tolist(), ends.tolist(), strict=True):
                    out[row] = data[a:b]
        return out

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and the start and size of each word's, of words that may repeat."""
        place: dict[str, int] = {}
        at = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
        coded = [w.encode("utf-8") for w in place]
        values, sizes = self.encode_many(np.frombuffer(b"".join(coded), np.uint8), np.fromiter(map(len, coded), np.int64, len(coded)))
        starts = np.cumsum(sizes) - sizes
        return values, starts[at], sizes[at]

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        counts = []
        marks = []
        for text in texts.to_pylist():
            before = len(words)
            for i, part in enumerate(text.split(END_OF_TEXT) if self.special else [text]):
                if i:
                    marks.append(len(words))
                    words.append("")
                words += SPLIT.findall(part)
            counts.append(len(words) - before)
        values, starts, sizes = self._encoded(words)
        if marks:
            starts[marks], sizes[marks] = len(values), 1
            values = np.append(values, np.uint32(END_OF_TEXT_ID))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        last = np.cumsum(counts)
        return ragged(values, starts, sizes), ends[last] - ends[last - counts]

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # stretches end at blanks and before line ends; a zero byte marks the first one, which has no blank before it
        marked = pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), "")
        lists = pc.split_pattern(marked, " ")
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary
        simple = pc.match_substring_regex(distinct, _SIMPLE).to_numpy(zero_copy_only=False)
        plain = distinct.take(pa.array(np.flatnonzero(simple)))
        line, closed = pc.starts_with(plain, "\n"), pc.match_substring_regex(plain, "[.,;:?]$")
        joint = pc.or_(line, pc.starts_with(plain, "\0"))
        # letters, perhaps with a line end before and a mark behind, are encoded from Arrow's buffers
        stems = pc.utf8_trim(plain, characters="\n\0.,;:?")
        stems = pc.if_else(joint, stems, pc.binary_join_element_wise(" ", stems, "")).dictionary_encode()
        values, sizes = self.encode_many(*_bytes_of(stems.dictionary))
        # the marks and the pieces of all other stretches
        other = distinct.take(pa.array(np.flatnonzero(~simple))).to_pylist()
        found = [SPLIT.findall(x.lstrip("\0") if x[:1] in "\0\n" and x else " " + x) for x in other]
        more, more_starts, more_sizes = self._encoded([*chain.from_iterable(found), *".,;:?\n"])
        starts = np.concatenate([np.cumsum(sizes) - sizes, more_starts + len(values)])
        sizes = np.concatenate([sizes, more_sizes])
        values = np.concatenate([values, more])
        line, closed = line.to_numpy(zero_copy_only=False), closed.to_numpy(zero_copy_only=False)
        counts = np.empty(len(distinct), np.int64)
        counts[simple] = 1 + line + closed
        counts[~simple] = [len(x) for x in found]
        first = np.cumsum(counts) - counts
        piece = np.empty(int(counts.sum()), np.int64)
        place = first[simple]
        piece[place[line]] = len(sizes) - 1
        piece[place + line] = stems.indices.to_numpy()
        mark = np.full(256, -1)
        mark[list(b".,;:?")] = np.arange(len(sizes) - 6, len(sizes) - 1)
        piece[(place + line)[closed] + 1] = mark[_bytes_of(pc.binary_slice(plain.filter(pa.array(closed)).cast(pa.binary()), -1))[0]]
        piece[np.repeat(~simple, counts)] = len(stems.dictionary) + np.arange(sum(map(len, found)))
        joined = ragged(values, starts[piece], sizes[piece])
        ends = np.concatenate([[0], np.cumsum(sizes[piece])])
        begin, size = ends[first], ends[first + counts] - ends[first]
        at = coded.indices.to_numpy()
        offsets = lists.offsets.to_numpy()
        totals = np.concatenate([[0], np.cumsum(size[at])])
        return ragged(joined, begin[at], size[at]), np.diff(totals[offsets - offsets[0]])


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file that is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
