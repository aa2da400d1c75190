"""Token counts of every prefix of a text, by dynamic programming over prefixes.

In a BPE vocabulary with a merge order, a token sequence is the encoding of its text exactly if each token encodes to itself and each pair of
neighbours encodes to that pair. The encoding of a prefix is therefore the encoding of a shorter prefix plus the one piece that ends it
and agrees with the shorter one's last token. One pass over the text finds that piece at every place; the count there is the
shorter prefix's count plus the piece's (a character outside the vocabulary counts its UTF-8 bytes). Work is linear in the text, also where it has no spaces.

``prefixes`` stores the counts: element p of a text's counts is what the library would return for its first p + 1 characters alone.
``totals``, ``count_at``, ``within`` and ``truncated`` answer from that table without encoding anything.

Scale: one scan, no shuffle. Counts start anew at a space, so a process keeps the counts of up to ``CACHE_CHARS`` characters of words; other
words are counted when met. Texts are handled ``CHUNK_BYTES`` at a time with the last pieces carried over, and leave as rows of at most ``PART`` characters, so
a text of any length needs the memory of one chunk beside the text itself.

A null text is an empty text: one row, no counts. Null and repeated ids are rows of their own (``key`` is the MD5 of the text; rows equal in
id and text are one document to ``within``). Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speechtable.llm import textbatch

#: Characters of one row of the table.
PART = 1 << 16
#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 20
#: Characters of words whose counts a process keeps.
CACHE_CHARS = 16_000_000
#: Pairs of pieces a process remembers.
PAIRS = 1_000_000
#: Bytes of a word that is worth keeping.
CACHED_WORD = 64
#: What the vocabulary writes for a space.
MARK = "▁"
_MARK_BYTES = tuple(MARK.encode())
_START = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "id {id}, key string, start long, counts array<int>, last boolean, n_chars long, n_bytes long, n_tokens long"

#: Characters, counts and last tokens around the end of what was walked so far.
State = tuple[str, list[int], list[int]]
#: The start of a text, or a character no piece has: nothing merges with it.
_NONE = 0
_EMPTY: State = ("", [0], [_NONE])


class Vocabulary:
    """Pieces of a sentencepiece BPE model and which of them may stand side by side."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if model.normalize("ﬁ  a ") != f"{MARK}ﬁ{MARK}{MARK}a{MARK}" or len(model.encode("\U0010fffd")) < 4:
            raise ValueError(f"{path}: only models without normalisation, with a leading space and with byte fallback are counted by prefix")
        if any(MARK in piece.lstrip(MARK) for piece in self.score):
            raise ValueError(f"{path}: pieces that run over a space are not supported")
        self.longest = max(map(len, self.score))
        self.names = ["", *self.score]
        self.number = {piece: i for i, piece in enumerate(self.names) if i}
        self.shift = len(self.names).bit_length()
        #: Lengths of the pieces with a given ending of two or three characters (1 is always one of them), longest first.
        ends: dict[str, set[int]] = {}
        for piece in self.score:
            for k in (2, 3):
                if len(piece) >= k:
                    ends.setdefault(piece[-k:], {1}).add(len(piece))
        for ending, lengths in ends.items():
            if len(ending) == 3 and ending[1:] in self.number:
                lengths.add(2)
        self.threes = {e: tuple(sorted(n, reverse=True)) for e, n in ends.items() if len(e) == 3}
        self.twos = {e: (2, 1) if e in self.number else (1,) for e in ends if len(e) == 2}
        self.pairs: dict[int, bool] = {}

    def encode(self, text: str) -> list[str]:
        """Merges by falling score, the leftmost first; for short strings."""
        parts = list(text)
        while len(parts) > 1:
            best = max((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == -np.inf:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def agree(self, before: int, piece: int) -> bool:
        """Whether a piece may follow a token."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        a, b = self.names[before], self.names[piece]
        found = self.encode(a + b) == ([a, b] if a else [b])
        self.pairs[before << self.shift | piece] = found
        return found

    def extend(self, text: str, counts: list[int], tokens: list[int]) -> None:
        """Go on from the places that ``counts`` and ``tokens`` (both one longer than what is walked) have up to the end of the text."""
        number, threes, twos, pairs, shift, agree = self.number.get, self.threes.get, self.twos.get, self.pairs.get, self.shift, self.agree
        for p in range(len(counts), len(text) + 1):
            sizes = threes(text[p - 3 : p]) if p > 2 else None
            if sizes is None:
                sizes = twos(text[p - 2 : p], (1,)) if p > 1 else (1,)
            for size in sizes:
                q = p - size
                if q < 0:
                    continue
                piece = number(text[q:p])
                if piece is None:
                    if size == 1:
                        counts.append(counts[q] + len(text[q].encode()))
                        tokens.append(_NONE)
                        break
                    continue
                before = tokens[q]
                ok = pairs(before << shift | piece)
                if agree(before, piece) if ok is None else ok:
                    counts.append(counts[q] + 1)
                    tokens.append(piece)
                    break
            else:
                raise AssertionError(f"no piece ends the prefix at {p} of {text[max(0, p - 40) : p]!r}")

    def walk(self, text: str, state: State) -> tuple[list[int], State]:
        """(tokens up to each character of the text, state after it), going on from a state."""
        tail, counts, tokens = state
        text, counts, tokens = tail + text, list(counts), list(tokens)
        self.extend(text, counts, tokens)
        n, keep = len(text), self.longest
        return counts[len(tail) + 1 :], (text[max(0, n - keep) :], counts[-keep - 1 :], tokens[-keep - 1 :])

    def walk_all(self, words: list[str]) -> list[list[int]]:
        """Counts up to each character of each word; in sorted order a word goes on where it leaves the one before."""
        out: list[list[int]] = [[]] * len(words)
        before, counts, tokens = "", [0], [_NONE]
        for i in sorted(range(len(words)), key=words.__getitem__):
            word = words[i]
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del counts[same + 1 :], tokens[same + 1 :]
            self.extend(word, counts, tokens)
            out[i], before = counts[1:], word
        return out


class Counter:
    """Prefix counts of text chunks, with a cache of words by hash."""

    def __init__(self, path: str):
        self.words = Vocabulary(path)
        #: A text's leading space is written before it, and is not one of its characters.
        self.begin = self.words.walk(MARK, _EMPTY)[1]
        self._clear()

    def _clear(self) -> None:
        self.keys, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int32)

    def _tables(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counts, start, size) with the place of each word's counts in a flat array."""
        hashes = textbatch.hash_spans(data, starts, ends)
        hashes = np.where(first, textbatch.mix(hashes ^ _START), hashes)
        order, heads, run = textbatch.distinct(hashes)
        sample = order[heads]
        keys = hashes[sample]
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = sample[self.keys[at] != keys] if len(self.keys) else sample
        text = data.tobytes()
        lead = first[new].tolist()
        found = self.words.walk_all([MARK * f + text[a:b].decode().replace(" ", MARK) for a, b, f in zip(starts[new].tolist(), ends[new].tolist(), lead)])
        made = [x[f:] for x, f in zip(found, lead)]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter((c for x in made for c in x), np.int32, int(sizes.sum()))
        short = ends[new] - starts[new] <= CACHED_WORD
        if len(self.counts) + len(flat) > CACHE_CHARS and len(self.counts):
            self._clear()
            return self._tables(data, starts, ends, first)
        counts, begun = np.concatenate([self.counts, flat]), len(self.counts) + np.cumsum(sizes) - sizes
        place = np.searchsorted(self.keys, hashes[new])
        all_keys, all_starts, all_sizes = (np.insert(a, place, b) for a, b in ((self.keys, hashes[new]), (self.starts, begun), (self.sizes, sizes)))
        at = np.searchsorted(all_keys, keys)
        which = np.empty(len(starts), np.int64)
        which[order] = at[run] if len(run) else at[:0]
        if short.all():
            self.keys, self.starts, self.sizes, self.counts = all_keys, all_starts, all_sizes, counts
        elif short.any():
            keep = short.nonzero()[0]
            place = np.searchsorted(self.keys, hashes[new][keep])
            begun = len(self.counts) + np.cumsum(sizes[keep]) - sizes[keep]
            self.counts = np.concatenate([self.counts, flat[np.repeat(short, sizes)]])
            self.keys, self.starts, self.sizes = (
                np.insert(a, place, b) for a, b in ((self.keys, hashes[new][keep]), (self.starts, begun), (self.sizes, sizes[keep])))
        return counts, all_starts[which], all_sizes[which]

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens up to each character of each row, characters before each row and in all) of whole texts."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        rows = np.searchsorted(lead, offsets)
        starts = _word_starts(data, lead, offsets)
        ends = np.append(starts[1:], len(data))
        heads = offsets[:-1][np.diff(offsets) > 0]
        counts, begun, sizes = self._tables(data, starts, ends, np.isin(starts, heads, assume_unique=True))
        last = counts[begun + sizes - 1].astype(np.int64)
        before = np.cumsum(last) - last
        row = np.searchsorted(heads, starts, "right") - 1
        base = before - before[np.searchsorted(starts, heads)][row]
        return (textbatch.gather(counts, begun, sizes) + np.repeat(base, sizes)).astype(np.int32), rows

    def long(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Counts of one long text, a window at a time; the word that a window's end cuts is walked on in the next one."""
        at, total, state, carried = 0, 0, None, 0
        while at < len(data):
            end = min(at + CHUNK_BYTES, len(data))
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            window = data[at:end]
            lead = np.flatnonzero((window & 0xC0) != 0x80)
            starts = _word_starts(window, lead, np.array([0, len(window)]))
            out = []
            if state is not None:
                opens = _is_mark(window, lead[:1])[0] and not state[0].endswith(MARK)
                head = 0 if opens else (int(starts[1]) if len(starts) > 1 else len(window))
                if head:
                    found, state = self.words.walk(window[:head].tobytes().decode().replace(" ", MARK), state)
                    out.append(np.array(found, np.int64) + carried)
                    total = carried + found[-1]
                starts = starts[starts >= head]
            if len(starts):
                # The last word may go on: walk it alone and keep its state.
                tail, first = int(starts[-1]), state is None
                if len(starts) > 1:
                    ends = starts[1:]
                    counts, begun, sizes = self._tables(window, starts[:-1], ends, (starts[:-1] == 0) & first)
                    last = counts[begun + sizes - 1].astype(np.int64)
                    out.append(textbatch.gather(counts, begun, sizes) + np.repeat(total + np.cumsum(last) - last, sizes))
                    total += int(last.sum())
                carried = total
                found, state = self.words.walk(window[tail:].tobytes().decode().replace(" ", MARK),
                                               self.begin if first and tail == 0 else _EMPTY)
                out.append(np.array(found, np.int64) + carried)
                total = carried + found[-1]
            yield np.concatenate(out).astype(np.int32)
            at = end


def _is_mark(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Which characters are a space or stand for one."""
    first = data[lead]
    out = first == 0x20
    wide = np.flatnonzero(first == _MARK_BYTES[0])
    at = lead[wide]
    whole = at + 2 < len(data)
    at, wide = at[whole], wide[whole]
    out[wide] = (data[at + 1] == _MARK_BYTES[1]) & (data[at + 2] == _MARK_BYTES[2])
    return out


def _word_starts(data: np.ndarray, lead: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of words: a run of spaces and what follows it, and whatever starts a row."""
    mark = _is_mark(data, lead)
    opens = mark & np.concatenate(([True], ~mark[:-1]))
    opens[np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])] = True
    return lead[opens]


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter a process and model."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def prefixes(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts of all prefixes, in rows of at most ``PART`` characters.

    Columns: id, key (MD5 of the text), start (characters before the row), counts (of the prefixes that end at each of the
    row's characters), last (whether the text ends here), and the text's n_chars, n_bytes and n_tokens up to the row's end.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(path)
        for batch in batches:
            data, offsets = textbatch.flat(batch.column(1))
            for a, b in _groups(offsets):
                ids = batch.column(0).slice(a, b - a)
                if b - a == 1 and offsets[b] - offsets[a] > CHUNK_BYTES:
                    yield from _long_rows(made, ids, data[offsets[a] : offsets[b]])
                else:
                    yield _rows(made, ids, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

    return rows.mapInArrow(run, SCHEMA.format(id=kind))


def _groups(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about a chunk's bytes together; a longer text is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, end
        at = end


def _batch(ids: pa.Array, keys: list[str], start, counts: np.ndarray, sizes: np.ndarray, last, chars, size, tokens) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.astype(np.int32, copy=False)))
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(keys, pa.string()), pa.array(start, long), lists, pa.array(last, pa.bool_()), pa.array(chars, long),
         pa.array(size, long), pa.array(tokens, long)], ["id", "key", "start", "counts", "last", "n_chars", "n_bytes", "n_tokens"])


def _rows(made: Counter, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    counts, rows = made.chunk(data, offsets)
    text = data.tobytes()
    hashes = [hashlib.md5(text[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    chars = np.diff(rows)
    parts = np.maximum(1, -(-chars // PART))
    which = np.repeat(np.arange(len(chars)), parts)
    number = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = number * PART
    end = np.minimum(start + PART, chars[which])
    at = rows[:-1][which] + end - 1
    tokens = np.where(end > 0, counts[np.maximum(at, 0)] if len(counts) else 0, 0)
    size = np.diff(offsets)[which]
    return _batch(ids.take(pa.array(which)), [hashes[i] for i in which.tolist()], start, counts, end - start, number == parts[which] - 1,
                  chars[which], size, tokens)


def _long_rows(made: Counter, ids: pa.Array, data: np.ndarray) -> Iterator[pa.RecordBatch]:
    key = hashlib.md5(data).hexdigest()
    chars = int(((data & 0xC0) != 0x80).sum())
    at, left = 0, np.zeros(0, np.int32)
    for found in made.long(data):
        left = np.concatenate([left, found])
        while len(left) >= PART or (at + len(left) == chars and len(left)):
            part, left = left[:PART], left[PART:]
            yield _batch(ids, [key], [at], part, np.array([len(part)]), [at + len(part) == chars], [chars], [len(data)], [int(part[-1])])
            at += len(part)


def totals(table: DataFrame) -> DataFrame:
    """One row a document: id, key, n_chars, n_bytes, n_tokens."""
    return table.where("last").select("id", "key", "n_chars", "n_bytes", "n_tokens")


def count_at(n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` characters, on the row of the table that holds that place (null on the others; 0 for none)."""
    n = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    at = (n - F.col("start")).cast("int")
    return F.when((n <= 0) & (F.col("start") == 0), 0).when((at >= 1) & (at <= F.size("counts")), F.get("counts", at - 1))


def within(table: DataFrame, budget: int) -> DataFrame:
    """The longest prefix of each text that has at most ``budget`` tokens: id, key, n_kept (characters), fits (the whole text does).

    A count may fall again when a character completes a piece, so the last place within the budget is taken, not the first beyond it.
    """
    places = F.filter(F.transform("counts", lambda c, i: F.when(c <= budget, i)), lambda i: i.isNotNull())
    kept = F.when(F.size(places) > 0, F.col("start") + F.element_at(places, -1) + 1).otherwise(0)
    found = table.select("id", "key", kept.cast("long").alias("n"), (F.col("last") & (F.col("n_tokens") <= budget)).alias("whole"))
    return found.groupBy("id", "key").agg(F.max("n").alias("n_kept"), F.max("whole").alias("fits"))


def truncated(docs: DataFrame, table: DataFrame, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents cut to the longest prefix within the budget; all columns, the cut text in place of the text (null stays null)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = within(table, budget).select(F.struct(F.col("id").alias("_id"), "key", "n_kept").alias("_cut"))
    rows = docs.select(F.struct("*").alias("_doc"), F.md5(text.cast("binary")).alias("_key"), F.col(id_col).alias("_own"))
    met = rows.join(kept, F.col("_own").eqNullSafe(F.col("_cut._id")) & (F.col("_key") == F.col("_cut.key")))
    return met.select(*[
        (F.when(F.col("_doc")[text_col].isNotNull(), F.left(F.col("_doc")[text_col], F.col("_cut.n_kept").cast("int"))) if c == text_col
         else F.col("_doc").getField(c)).alias(c) for c in docs.columns])
