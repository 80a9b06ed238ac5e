"""Best-two-fit packing of documents into token sequences of a fixed length.

A document is its tokens and an end id.  One longer than a sequence is cut into pieces of
sequence length, whose last may be shorter; others stay whole.  Pieces that fill a sequence
are sequences already.  The rest is dealt to tasks in turn, so each task sees the same mix
of lengths, equal pieces are spread too, and each packs its share: it opens a sequence with the longest piece left, adds
the longest piece that fits as long as one does, and then, if there is a gap, takes the
smallest piece out again if two unpacked pieces fit the widened gap more tightly.  A task
leaves at most about one sequence half full, so the loss against packing everything at once
is about one sequence in ``PIECES_PER_TASK`` pieces.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from operator import add
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from extractkit.llm.common import remembered, small_batches, stored
from extractkit.session import spread

LENGTH = 2048
PIECES_PER_TASK = 50_000
#: Words of a generation a task remembers with their ids; it keeps two generations.
REMEMBERED = 300_000

#: Bytes of rows whose words are looked up together.
JOINED = 8_000_000

#: Marks that may stand after the letters of a plain word.
MARKS = punctuation


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters() | {32: " "}  # a space parts the words that are encoded together
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def parted(word: str) -> tuple[str, str]:
    """The lower-cased letters of a plain word and the marks after them; nothing and the word itself for any other one."""
    letters = word.rstrip(MARKS)
    if letters.isalpha():
        low = letters.lower()
        if word.isascii() or is_normalized("NFC", word) and is_normalized("NFC", low) and len(low) == len(letters) and "\u03a3" not in word:
            return low, word[len(letters) :]
    return "", word


class WordIds:
    """The ids of words as bytes (unsigned, little-endian, 32 bits), remembered from text to text.

    The vocabulary's own splitting never joins text across a space or line feed, so a text's
    ids are those of its words, one after the other.  It also parts letters from the marks
    after them and lower-cases; the letters of words of this plain form go to the merges at
    once, all new ones of a batch together, any other word through the whole tokenizer.

    A word asked for since ``recent`` was begun is in there; when that is full it becomes
    ``older``, so that frequent words stay and those seen once go.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self.merges = Tokenizer(self.model)
        self.merges.pre_tokenizer = WhitespaceSplit()
        vocab, suffix = self.tokenizer.get_vocab(), getattr(self.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # by id: does it end a word
        self.last[[at for token, at in vocab.items() if suffix and token.endswith(suffix)]] = True
        self.recent = {"": b""}
        self.older: dict[str, bytes] = {}

    def known(self, words: list[str], encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """What is remembered of some words; ``encode`` gives the rest."""
        found = list(map(self.recent.get, words))
        if missing := list({word: None for word, ids in zip(words, found) if ids is None}):
            again = list(map(self.older.get, missing))
            if new := [word for word, ids in zip(missing, again) if ids is None]:
                learnt = iter(encode(new))
                again = [next(learnt) if ids is None else ids for ids in again]
            self.recent.update(zip(missing, again))
            found = [self.recent[word] if ids is None else ids for word, ids in zip(words, found)]
        return found

    def whole(self, words: list[str]) -> list[bytes]:
        return [np.array(found.ids, "<u4").tobytes() for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of words of lower-case letters."""
        spelt = " ".join(words).encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = np.array(self.merges.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
        if len(ends) != len(words):  # a vocabulary that does not mark the ends of words
            return [np.array([token.id for token in self.model.tokenize(word)], "<u4").tobytes() for word in spelt.split(" ")]
        data, ends = ids.tobytes(), ends.tolist()
        return [data[start:end] for start, end in zip([0, *ends], ends)]

    def ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of some different words."""
        if len(self.recent) >= REMEMBERED:
            self.older, self.recent = self.recent, {"": b""}
        found = list(map(self.recent.get, words))  # most are lower-case letters seen before
        parts = [parted(word) for word, ids in zip(words, found) if ids is None]
        letters = self.known([low for low, _ in parts], self.merged)
        made = map(add, letters, self.known([rest for _, rest in parts], self.whole))
        return [next(made) if ids is None else ids for ids in found]

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, a null one counting as empty; a word is looked up once for all of them."""
        words = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        ids = np.array(self.ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), dtype=object)
        numbers, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(words).to_numpy()).tolist()
        for start, end in zip([0, *ends], ends):
            yield b"".join(ids[numbers[start:end]].tolist())

    def text(self, text: str | None) -> bytes:
        return next(self.texts(pa.array([text], pa.string())))


def joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of up to ``size`` bytes; a larger one stays as it is."""
    held, total = [], 0
    for batch in batches:
        if held and total + batch.nbytes > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _pieces(vocabulary: str, end_id: int, length: int):
    end, step = np.array([end_id], "<u4").tobytes(), 4 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        words = remembered(("words", zlib.crc32(vocabulary.encode())), lambda: WordIds(vocabulary))
        for batch in joined(batches, JOINED):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.texts(batch.column("text"))):
                ids += end
                rows += [
                    (doc_id, at // step, at // 4, len(part := ids[at : at + step]) // 4, zlib.crc32(part)) for at in range(0, len(ids), step)
                ]
            columns = list(zip(*rows))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def token_pieces(documents: DataFrame, vocabulary_path: str, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's pieces.

    A null or empty text is the end id alone; repeated rows are documents of their own; a
    null ``doc_id`` stays null; no rows give no rows; other columns are ignored.
    """
    small_batches(documents.sparkSession)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()  # a few MB, sent to the tasks: the file need be on the driver only
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return spread(docs, "doc_id").mapInArrow(_pieces(vocabulary, end_id, length), PIECES)


def pack_lengths(lengths: list[int], capacity: int) -> Iterator[list[int]]:
    """Best-two-fit: lists of positions in ``lengths``, one for each sequence.

    Bit n of ``left`` says that a piece of length n is unpacked, bit ``capacity - n`` of
    ``mirrored`` the same, so all pairs of a given sum are one shift and one AND.
    """
    waiting: dict[int, list[int]] = defaultdict(list)
    for at in range(len(lengths) - 1, -1, -1):
        waiting[lengths[at]].append(at)
    left = sum(1 << n for n in waiting)
    mirrored = sum(1 << (capacity - n) for n in waiting)

    def take(n: int) -> int:
        nonlocal left, mirrored
        at = waiting[n].pop()
        if not waiting[n]:
            left ^= 1 << n
            mirrored ^= 1 << (capacity - n)
        return at

    def give(n: int, at: int) -> None:
        nonlocal left, mirrored
        waiting[n].append(at)
        left |= 1 << n
        mirrored |= 1 << (capacity - n)

    while left:
        gap, chosen = capacity, []
        while fits := left & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            chosen.append(take(n))
            gap -= n
        if gap and len(chosen) > 1:
            smallest = lengths[chosen[-1]]  # the longest that fits is taken first
            for total in range(gap + smallest, smallest, -1):
                ones = left & (mirrored >> (capacity - total))
                if total % 2 == 0 and len(waiting.get(total // 2, ())) < 2:
                    ones &= ~(1 << (total // 2))
                if ones:
                    n = ones.bit_length() - 1
                    give(smallest, chosen.pop())
                    chosen += [take(n), take(total - n)]
                    break
        yield chosen


def _packed(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])  # the same places after a retry
        order, sequence, offset = array("q"), array("q"), array("q")
        lengths = table.column("length").to_pylist()
        base = TaskContext.get().partitionId() << 40
        for number, chosen in enumerate(pack_lengths(lengths, capacity)):
            place = 0
            for at in chosen:
                order.append(at)
                sequence.append(base + number)
                offset.append(place)
                place += lengths[at]
        table = table.take(pa.array(np.array(order)))
        table = table.append_column("sequence_id", pa.array(np.array(sequence))).append_column("offset", pa.array(np.array(offset)))
        yield from table.to_batches(max_chunksize=50_000)

    return run


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: a place for each, gapless from 0.

    ``pieces`` has the columns of :func:`token_pieces` and is written to the shared scratch
    folder, since its number of rows decides the number of tasks; a task that deals them again after a
    loss reads the same rows, which Spark sorts first, and deals them alike.  Only these five numbers a
    piece move; no token does.
    """
    pieces = stored(pieces, "pieces")
    tasks = max(1, -(-pieces.count() // PIECES_PER_TASK))
    return pieces.repartition(tasks).mapInArrow(_packed(length), PIECES + ", sequence_id long, offset long")


def pack_documents(documents: DataFrame, vocabulary_path: str, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Every piece of every document with its sequence and place; see :func:`token_pieces` and :func:`pack`."""
    return pack(token_pieces(documents, vocabulary_path, end_id, length), length)
