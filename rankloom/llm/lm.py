"""Language-model scoring by deleted interpolation.

Texts are sequences of words and one end.  Unigram, bigram and trigram
maximum-likelihood estimates of the training documents are mixed with the
uniform distribution over the known tokens and one unknown:

    P1(w)     = l1        c(w) / N        + (1 - l1) / (V + 1)
    P2(w|v)   = l2[b(v)]  c(v w) / c(v)   + (1 - l2[b(v)]) P1(w)
    P3(w|u v) = l3[b(u v)] c(u v w) / c(u v) + (1 - l3[b(u v)]) P2(w|v)

b(x) is the bucket of the context's frequency, by powers of two.  The weights
are learned by expectation-maximisation on held-out counts: one part of the
training documents (remainder 1 of ``2 * folds``) is taken out of the counts,
every token of it is predicted from the rest, and each round adds up over all
of them, on the executors, what each estimate contributed.  Scores use all
training documents.

* **Blocks.**  A task packs its texts into blocks of about ``BLOCK_WORDS``
  words with a dictionary of their own; a text may go through several.
* **Words** of the dictionaries meet by a hash, as compressed lists; their
  counts are summed and they are numbered there, and the numbers and counts go
  back to the blocks that have them.
* **Runs.**  A block asks once for each distinct run of two or three words
  it has, with its own counts; runs meet by a hash of the whole run, their
  counts are summed, and each block gets what the others have of those it asked for.  A run
  with a word that no other block has is counted in its block already; one
  with a word unknown in training has a count of 0.  So a frequent run is one
  entry per block and no task gets more for it.

What is gathered grows with the corpus; the driver holds only the weights
(a few dozen numbers) and totals.

Defined results: a null text is empty (one token: the end); a null doc_id is
hashed as the empty string; repeated rows are documents of their own; texts of
any length go through blocks of bounded size; with no training document every
estimate is 0 and N is 0; with none in the held-out part the weights stay at
their first values; an empty table gives no rows; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release, scratch_path
from .common import ASCII_SPACE, require, text_or_empty
from .words import Splitter, narrow, pack, pack_words, unpack, unpack_words

FOLDS = 10
ADDED = 0.1            # of the base score
BLOCK_WORDS = 1 << 19
PART_WORDS = 1 << 19   # words whose runs meet in one task
ROUNDS = 12
BUCKETS = 40           # powers of two of a context's frequency
BEGIN, END = 0, 1      # tokens that are no words; words follow
HELD_OUT, TRAIN, DELETED = 0, 1, 2


def _crc(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.int64)


class _Texts:
    """Texts of one task until they fill a block."""

    def __init__(self):
        self.tail = [], []       # the last two tokens of the text that goes on: marks, words
        self._new()

    def _new(self):
        self.words, self.marks, self.docs, self.sizes = [], [], [], []
        self.size = self.skip = 0

    def add(self, words: pa.Array, counts: np.ndarray, docs: list, goes_on: bool, ends: bool):
        """Texts with ``counts`` words each; the first may go on from before, the last may go on."""
        size = counts + 2
        if goes_on:
            size[0] -= 1
        if not ends:
            size[-1] -= 1
        stop = np.cumsum(size)
        mark = np.full(int(stop[-1]), -1, np.int8)
        mark[(stop - size)[1 if goes_on else 0:]] = BEGIN
        mark[(stop - 1)[: len(stop) if ends else -1]] = END
        if goes_on and not self.size:
            self.skip = len(self.tail[0])
            self._put(pa.array([w for w in self.tail[1] if w is not None], pa.string()), np.array(self.tail[0], np.int8))
            self.docs, self.sizes = docs[:1], [self.skip]
        if goes_on:
            self.sizes[-1] += int(size[0])
            docs, more = docs[1:], size[1:]
        else:
            more = size
        self._put(words, mark)
        self.docs += docs
        self.sizes += more.tolist()
        if not ends:
            last = mark[-2:].tolist()
            n = sum(m < 0 for m in last)
            spelled = iter(words[len(words) - n:].to_pylist())
            marks, texts = (self.tail if goes_on else ([], []))
            self.tail = (marks + last)[-2:], (texts + [next(spelled) if m < 0 else None for m in last])[-2:]

    def _put(self, words, mark):
        self.words.append(words)
        self.marks.append(mark)
        self.size += len(mark)

    def take(self):
        """(skip, tokens, docs, sizes, words, counts, place): the dictionary's
        words in the order of their hash, with their counts in all texts, in
        training and in its held-out part, and the token that stands for each
        (most frequent first)."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        code, mark = coded.indices.to_numpy(zero_copy_only=False), np.concatenate(self.marks)
        frequent = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(frequent), np.int32)
        rank[frequent] = np.arange(2, len(frequent) + 2)
        order = np.argsort(_crc(coded.dictionary), kind="stable")
        tokens = mark.astype(np.int32)
        tokens[mark < 0] = rank[code]
        kind = np.repeat(np.array([k for _, _, k in self.docs], np.int8), self.sizes)
        counts = [np.bincount(tokens[self.skip:][kind[self.skip:] >= k], minlength=len(order) + 2)[rank[order]] for k in (HELD_OUT, TRAIN, DELETED)]
        out = self.skip, tokens, self.docs, self.sizes, coded.dictionary.take(pa.array(order)), counts, rank[order]
        self._new()
        return out


def _block_schema(id_type: str) -> str:
    return (f"block long, deleted boolean, skip int, n_words long, n long, d long, texts long, deleted_texts long, tokens binary, "
            f"docs array<struct<row: long, doc_id: {id_type}, kind: int, size: long>>, words binary, counts binary, place binary")


def blocks(docs: DataFrame, doc_id: str, text: str, folds: int, block_words: int) -> DataFrame:
    """Texts as blocks of tokens; those of the held-out part are apart."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    kind = F.when(crc % folds == 0, HELD_OUT).when(crc % (2 * folds) == 1, DELETED).otherwise(TRAIN)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, task = Splitter(ASCII_SPACE.encode()), TaskContext.get().partitionId() << 32
        packs, made, seen = (_Texts(), _Texts()), 0, 0

        def row(deleted: bool):
            skip, tokens, held, sizes, words, counts, place = packs[deleted].take()
            rows, ids, kinds = zip(*held)
            ended = np.repeat(kinds, sizes)[np.flatnonzero(tokens[skip:] == END) + skip]  # a text counts where it ends
            texts = int((ended >= TRAIN).sum()), int((ended == DELETED).sum())
            totals = int(counts[1].sum()) + texts[0], int(counts[2].sum()) + texts[1], *texts
            listed = pa.StructArray.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, id_arrow), pa.array(kinds, pa.int32()), pa.array(sizes, pa.int64())],
                ["row", "doc_id", "kind", "size"])
            return pa.RecordBatch.from_arrays(
                [pa.array([task + made], pa.int64()), pa.array([deleted]), pa.array([skip], pa.int32()), pa.array([len(tokens)], pa.int64()),
                 *[pa.array([int(x)], pa.int64()) for x in totals],
                 pa.array([pack(tokens)], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed),
                 pa.array([pack_words(words)], pa.binary()), pa.array([pack(*[narrow(x) for x in counts])], pa.binary()), pa.array([pack(place)], pa.binary())],
                ["block", "deleted", "skip", "n_words", "n", "d", "texts", "deleted_texts", "tokens", "docs", "words", "counts", "place"])

        id_arrow = None
        for batch in batches:
            id_arrow, ids = batch.schema.field(0).type, batch.column(0).to_pylist()
            kinds = batch.column(1).to_numpy(zero_copy_only=False)
            for part in splitter.slices(batch.column(2)):
                counts = np.bincount(part.row - part.first, minlength=part.last - part.first + 1)
                of = kinds[part.first: part.last + 1]
                for deleted in (False, True):
                    mine = np.flatnonzero((of == DELETED) == deleted)
                    if not len(mine):
                        continue
                    words = part.words if len(mine) == len(of) else part.words.filter(pa.array((kinds[part.row] == DELETED) == deleted))
                    held = [(task + seen + part.first + i, ids[part.first + i], int(of[i])) for i in mine.tolist()]
                    packs[deleted].add(words, counts[mine], held, part.goes_on, part.ends)
                    if packs[deleted].size >= block_words:
                        yield row(deleted)
                        made += 1
            seen += batch.num_rows
        for deleted in (False, True):
            if packs[deleted].size:
                yield row(deleted)
                made += 1

    rows = docs.select(F.col(doc_id).alias("doc_id"), kind.alias("kind"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(encode, _block_schema(id_type))


class _Runs(NamedTuple):
    """The distinct runs of a block.  Tokens are places in its dictionary."""

    kind: np.ndarray     # of each token
    owned: np.ndarray    # tokens that are scored here
    two: np.ndarray      # per token, its run of two (-1: none known)
    three: np.ndarray    # per token, its run of three (-1: none known)
    counts: np.ndarray   # (runs, 2): here, in training and in its held-out part
    asked: np.ndarray    # runs that other blocks may have, in the order of the requests
    key: np.ndarray      # their (first word + 1 or 0, second << 32 | third)
    part: np.ndarray     # where they are counted
    n_two: int


def _mixed(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h, tail = key[:, 0].astype(np.uint64), key[:, 1].astype(np.uint64)
        h *= np.uint64(0x9E3779B97F4A7C15)
        tail *= np.uint64(0xD6E8FEB86659FD93)
        h += tail
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        return h


def _hash(key: np.ndarray) -> np.ndarray:
    return _mixed(key) >> np.uint64(20)


def _order(code: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of numbers below 2 ** bits: each is sorted together with its place, if both fit in one."""
    wide = len(code).bit_length()
    if bits + wide > 63:
        return np.argsort(code, kind="stable")
    both = np.left_shift(code, wide, dtype=np.int64)
    both |= np.arange(len(code))
    both.sort()
    both &= (1 << wide) - 1
    return both


def _sorted(part: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """An order by part, first word and second word, the same on every machine."""
    order = np.arange(len(part))
    for key in (tail >> 32, head, part):  # stable, the last key first
        order = order[_order(key[order], int(key.max(initial=0)).bit_length())]
    return order


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low, place): the distinct pairs of a block's numbers (below
    2 ** 31), sorted, and the place of each in them."""
    bits = [int(x.max(initial=0)).bit_length() for x in (high, low)]
    code = high.astype(np.int64)
    code <<= bits[1]
    code |= low
    order = _order(code, sum(bits))
    code = code[order]
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    place = np.empty(len(code), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    del order
    code = code[new]
    return (code >> bits[1]).astype(np.int32), (code & ((1 << bits[1]) - 1)).astype(np.int32), place


def _alike(head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, int]:
    """(group, groups): the group of equal runs that each run is in.  Runs are
    sorted by a hash; should two of one hash differ, by themselves."""
    bits = 63 - len(head).bit_length()
    hashed = (_mixed(np.stack([head, tail], axis=1)) >> np.uint64(64 - bits)).astype(np.int64)
    order = _order(hashed, bits)
    same = hashed[order]
    same = same[1:] == same[:-1]
    differ = lambda: (np.diff(head[order]) != 0) | (np.diff(tail[order]) != 0)
    new = np.ones(len(order), bool)
    new[1:] = differ()
    if (new[1:] & same).any():
        order = np.lexsort((tail, head))
        new[1:] = differ()
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, int(new.sum())


def _runs(tokens: np.ndarray, skip: int, kind: np.ndarray, gid: np.ndarray, m: np.ndarray, parts: int) -> _Runs:
    """``gid`` and ``m`` by token: its number (-1: not in training) and its count in all texts.

    A worker's memory is largest here: numbers of a block take 4 bytes, and what is read no more goes."""
    word = tokens != BEGIN
    owned = word.copy()
    owned[:skip] = False
    known = (gid >= 0)[tokens]
    ahead = lambda x, first: np.concatenate([np.array([first], x.dtype), x[:-1]])
    before = ahead(tokens, BEGIN)
    has = word & known & ahead(known, False)
    left, right, inverse = _distinct(before[has], tokens[has])
    two = np.full(len(tokens), -1, np.int32)
    two[has] = inverse
    # a run of three is the token before with its run of two, and this token
    last = ahead(two, -1)
    has = owned & (two >= 0) & (last >= 0) & (before != BEGIN)
    pair, right3, inverse = _distinct(last[has], tokens[has])
    del before, last
    three = np.full(len(tokens), -1, np.int32)
    three[has] = inverse + np.int32(len(left))
    del inverse, has
    first, second, third = left[pair], np.concatenate([left, right[pair]]), np.concatenate([right, right3])
    n_two, total = len(left), len(left) + len(pair)
    del left, right, pair, right3
    counts = np.zeros((total, 2), np.int32)
    for c, least in enumerate((TRAIN, DELETED)):
        of = owned & (kind >= least)
        if of.any():
            counts[:n_two, c] = np.bincount(two[of & (two >= 0)], minlength=n_two)
            counts[n_two:, c] = np.bincount(three[of & (three >= 0)] - n_two, minlength=total - n_two)
    here = np.bincount(tokens[owned], minlength=len(gid))
    elsewhere = m > here
    elsewhere[[BEGIN, END]] = True
    ask = elsewhere[second] & elsewhere[third]
    ask[n_two:] &= elsewhere[first]
    asked = np.flatnonzero(ask)
    key = np.zeros((len(asked), 2), np.int64)
    long = asked >= n_two
    key[long, 0] = gid[first[asked[long] - n_two]] + 1
    key[:, 1] = gid[second[asked]]
    key[:, 1] <<= 32
    key[:, 1] |= gid[third[asked]]
    del ask, long, first, second, third
    part = (_hash(key) % np.uint64(parts)).astype(np.int64)
    order = _sorted(part, key[:, 0], key[:, 1])
    return _Runs(kind, owned, two, three, counts, asked[order].astype(np.int32), key[order], part[order], n_two)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of all batches, one by one: a row is a block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _opened(r: dict, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, _Runs]:
    """(tokens, gid, n, d, runs) of a block; the last three by place in its dictionary."""
    tokens, (gid, m, n, d) = unpack(r["tokens"])[0], (x.astype(np.int64) for x in unpack(r["lexicon"]))
    gid = gid - 1
    kind = np.repeat(np.array([x["kind"] for x in r["docs"]], np.int8), [x["size"] for x in r["docs"]])
    return tokens, gid, n, d, _runs(tokens, r["skip"], kind, gid, m, parts)


def _spell(parts: int):
    """A block's words and their counts, a list for each part."""

    def spell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for r in batch.to_pylist():
                words, counts = unpack_words(r["words"]), unpack(r["counts"])
                part = lambda i: zlib.crc32(words[i].as_buffer()) * parts >> 32
                edge = np.array([bisect_left(range(len(words)), p, key=part) for p in range(parts)] + [len(words)])
                here = np.flatnonzero(np.diff(edge))
                made = [(pack_words(words[edge[p]:edge[p + 1]]), pack(*[x[edge[p]:edge[p + 1]] for x in counts])) for p in here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here, pa.int64()), pa.array([r["block"]] * len(here), pa.int64()),
                     pa.array([x for x, _ in made], pa.binary()), pa.array([x for _, x in made], pa.binary())],
                    ["part", "block", "words", "counts"])

    return spell


def _number(parts: int):
    """Numbers (moved by one, 0: not in training) and counts of one part's
    words for every block that has them; and how many are in training."""

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        lists = [unpack_words(b) for b in rows["words"]]
        code = pa.concat_arrays(lists).dictionary_encode()
        known, code = len(code.dictionary), code.indices.to_numpy(zero_copy_only=False)
        counts = [np.concatenate(x) for x in zip(*[unpack(b) for b in rows["counts"]])]
        m, n, d = (np.bincount(code, x, minlength=known).astype(np.int64) for x in counts)
        rank = np.empty(known, np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(known)
        gid = np.where(n > 0, END + 2 + rank * parts + part, 0)
        cuts = np.cumsum([len(x) for x in lists])[:-1]
        body = [pack(*[narrow(x[c]) for x in (gid, m, n, d)]) for c in np.split(code, cuts)]
        out = pd.DataFrame({"block": rows["block"], "part": part, "body": body, "known": 0})
        return pd.concat([out, pd.DataFrame([(-1, part, b"", int((n > 0).sum()))], columns=out.columns)])

    return number


def _lexicon(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's replies in the order of its tokens."""
    for batch in rows:
        out = []
        for r in batch.select(["place", "numbers"]).to_pylist():
            place = unpack(r["place"])[0]
            lexicon = np.zeros((4, len(place) + 2), np.int64)
            lexicon[0, [BEGIN, END]] = BEGIN + 1, END + 1
            got = [unpack(x["body"]) for x in sorted(r["numbers"] or [], key=lambda x: x["part"])]
            for i, x in enumerate(zip(*got)):
                lexicon[i, place] = np.concatenate(x)
            out.append(pack(*[narrow(x) for x in lexicon]))
        kept = ["block", "deleted", "skip", "tokens", "docs"]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(out, pa.binary())], names=[*kept, "lexicon"])


def _requests(parts: int):
    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(rows):
            runs = _opened(r, parts)[-1]
            edge = np.searchsorted(runs.part, np.arange(parts + 1))
            here = np.flatnonzero(np.diff(edge))
            made = []
            for p in here:
                a, b = edge[p], edge[p + 1]
                n, d = runs.counts[runs.asked[a:b]].T
                head, tail = runs.key[a:b].T
                second = tail >> 32  # as the difference to the run before, where the first word is the same
                step = second - np.where(np.diff(head, prepend=-1) == 0, np.concatenate([[0], second[:-1]]), 0)
                made.append(pack(narrow(np.diff(head, prepend=0)), narrow(step), narrow(tail & ((1 << 32) - 1)), narrow(n), narrow(d)))
            del runs
            yield pa.RecordBatch.from_arrays(
                [pa.array(here, pa.int64()), pa.array([r["block"]] * len(here), pa.int64()),
                 pa.array([r["deleted"]] * len(here), pa.bool_()), pa.array(made, pa.binary())], ["part", "block", "deleted", "body"])

    return ask


def _seconds(head_step: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Second words from their differences, which begin anew with every first word."""
    total = np.cumsum(step)
    new = head_step != 0
    new[:1] = True
    heads = np.flatnonzero(new)
    before = np.concatenate([[0], total[heads[1:] - 1]])
    return total - before[np.cumsum(new) - 1]


def _sums(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of one part's runs in all other blocks, for every block that asks."""
    got = [[x.astype(np.int64) for x in unpack(b)] for b in rows["body"]]
    size = [len(x[0]) for x in got]
    head = np.concatenate([np.cumsum(x[0]) for x in got])
    tail = np.concatenate([_seconds(x[0], x[1]) << 32 | x[2] for x in got])
    n, d = np.concatenate([x[3] for x in got]), np.concatenate([x[4] for x in got])
    group, known = _alike(head, tail)
    n, d = (np.bincount(group, x, minlength=known).astype(np.int64)[group] - x for x in (n, d))
    cuts = np.cumsum(size)[:-1]
    return pd.DataFrame({"block": rows["block"], "deleted": rows["deleted"], "part": rows["part"],
                         "body": [pack(narrow(a), narrow(b)) for a, b in zip(np.split(n, cuts), np.split(d, cuts))]})


class Totals(NamedTuple):
    """Sizes of the training documents, and of their held-out part."""

    tokens: int    # N
    texts: int
    known: int     # V
    deleted_tokens: int
    deleted_texts: int

    def __reduce__(self):
        return Totals, tuple(self)


def _counts(r: dict, parts: int, totals: Totals, without: bool = False):
    """(owned, counts, contexts) of a block's tokens for the orders 1 to 3 and
    2 to 3: in training, or ``without`` its held-out part."""
    tokens, gid, n, d, runs = _opened(r, parts)
    mine, run_two, run_three, counts, asked = runs.owned, runs.two, runs.three, runs.counts, runs.asked
    del runs, gid
    pick = (lambda x, y: x - y) if without else (lambda x, y: x)
    sums = np.zeros(len(counts) + 1, np.int64)  # run -1: never found
    sums[:-1] = pick(*counts.T)
    replies, at = sorted(r["replies"] or [], key=lambda x: x["part"]), 0
    for x in replies:
        got = pick(*unpack(x["body"]))
        sums[asked[at:at + len(got)]] += got
        at += len(got)
    if replies and at != len(asked):
        raise ValueError(f"block {r['block']}: {len(asked)} runs asked for, {at} answered")
    del counts, asked
    n, texts = pick(n, d), pick(totals.texts, totals.deleted_texts)
    n[[BEGIN, END]] = texts
    owned = np.flatnonzero(mine)
    before = owned - 1  # an owned token has one before it, in its text
    one, two, three = n[tokens[owned]], sums[run_two[owned]], sums[run_three[owned]]
    over_two, over_three = n[tokens[before]], sums[run_two[before]]
    begins = tokens[before] == BEGIN
    over_three[begins], three[begins] = texts, two[begins]  # the text begins twice
    return mine, [one, two, three], [over_two, over_three]


def bucket(n: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + the floor of log2 of its count."""
    return np.minimum(np.frexp(n.astype(np.float64))[1], BUCKETS - 1)


class Mixture(NamedTuple):
    one: float
    two: np.ndarray
    three: np.ndarray

    def __reduce__(self):
        return Mixture, tuple(self)


def first_mixture() -> Mixture:
    half = np.full(BUCKETS, 0.5)
    half[0] = 0.0
    return Mixture(0.9, half, half.copy())


def _estimates(counts, contexts, tokens: int) -> list[np.ndarray]:
    """Maximum-likelihood estimates of orders 1 to 3 (0 where the context is new)."""
    over = [np.full(len(counts[0]), tokens), *contexts]
    return [np.divide(c, o, out=np.zeros(len(c)), where=o > 0) for c, o in zip(counts, over)]


def probabilities(mixture: Mixture, estimates, contexts, known: int):
    """(P1, P2, P3) and the weights used."""
    two, three = mixture.two[bucket(contexts[0])], mixture.three[bucket(contexts[1])]
    p1 = mixture.one * estimates[0] + (1 - mixture.one) / (known + 1)
    p2 = two * estimates[1] + (1 - two) * p1
    return p1, p2, three * estimates[2] + (1 - three) * p2, two, three


def scores(mixture: Mixture, counts, contexts, totals: Totals, step: int = 1 << 16) -> np.ndarray:
    """log10 P3 of each token, some tokens at a time."""
    out = np.empty(len(counts[0]))
    for a in range(0, len(out), step):
        some, over = [x[a:a + step] for x in counts], [x[a:a + step] for x in contexts]
        out[a:a + step] = np.log10(probabilities(mixture, _estimates(some, over, totals.tokens), over, totals.known)[2])
    return out


def expectations(mixture: Mixture, counts, contexts, totals: Totals) -> np.ndarray:
    """(5, BUCKETS): for orders 3 and 2 the tokens' shares that the estimate
    explains and those it was asked for, by bucket; then both of order 1."""
    est = _estimates(counts, contexts, totals.tokens - totals.deleted_tokens)
    p1, p2, p3, two, three = probabilities(mixture, est, contexts, totals.known)
    b2, b3 = bucket(contexts[0]), bucket(contexts[1])
    r3 = three * est[2] / p3
    r2 = two * est[1] / p2
    r1 = mixture.one * est[0] / p1
    add = lambda b, x: np.bincount(b, x, minlength=BUCKETS)
    rest = (1 - r3) * (1 - r2)
    last = np.zeros(BUCKETS)
    last[:2] = (rest * r1).sum(), rest.sum()
    return np.stack([add(b3, r3), add(b3, np.ones(len(r3))), add(b2, (1 - r3) * r2), add(b2, 1 - r3), last])


def maximise(sums: np.ndarray) -> Mixture:
    """The weights that the sums ask for, half a token added on either side."""
    share = lambda got, of: (got + 0.5) / (of + 1.0)
    three, two = share(sums[0], sums[1]), share(sums[2], sums[3])
    three[0] = two[0] = 0.0
    return Mixture(float(share(sums[4, 0], sums[4, 1])), two, three)


def fit(held_out: DataFrame, totals: Totals, rounds: int = ROUNDS) -> Mixture:
    """Expectation-maximisation over ``held_out`` (one row per block: its
    counts without the held-out part, packed); a round is one aggregate."""
    mixture = first_mixture()
    for _ in range(rounds):
        def expect(rows: Iterator[pa.RecordBatch], mixture=mixture) -> Iterator[pa.RecordBatch]:
            total = np.zeros((5, BUCKETS))
            for batch in rows:
                for blob in batch.column(0).to_pylist():
                    c1, c2, c3, o2, o3 = unpack(blob)
                    total += expectations(mixture, (c1, c2, c3), (o2, o3), totals)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(5 * BUCKETS), pa.int32()), pa.array(total.reshape(-1))], ["i", "x"])

        got = held_out.select("counts").mapInArrow(expect, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        if not any(r["x"] for r in got):
            return mixture
        mixture = maximise(np.array([r["x"] for r in sorted(got, key=lambda r: r["i"])]).reshape(5, BUCKETS))
    return mixture


def score(docs: DataFrame, folds: int = FOLDS, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
          block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every document.  Documents whose crc32(doc_id as text) is divisible by
    ``folds`` are never learned from."""
    require(docs, [doc_id, text])
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    at, words_at = scratch_path(spark, "lm"), scratch_path(spark, "lm")
    held = materialize(blocks(docs, doc_id, text, folds, block_words), at)
    size = held.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).head()["n"]
    parts = max(1, -(-size // part_words))
    numbers = materialize(held.select("block", "words", "counts").mapInArrow(
        _spell(parts), "part long, block long, words binary, counts binary").groupBy("part").applyInPandas(
        _number(parts), "block long, part long, body binary, known long"), words_at)
    vocabulary = numbers.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("v")).head()["v"]
    one = held.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "d", "texts", "deleted_texts")]).head()
    totals = Totals(one["n"], one["texts"], vocabulary + (one["texts"] > 0), one["d"], one["deleted_texts"])

    docs_type = f"array<struct<row: long, doc_id: {id_type}, kind: int, size: long>>"
    back = numbers.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias("numbers"))
    ready = materialize(held.select("block", "deleted", "skip", "tokens", "docs", "place").join(
        back, "block", "left").mapInArrow(_lexicon, f"block long, deleted boolean, skip int, tokens binary, docs {docs_type}, lexicon binary"))
    release(spark, at, words_at)
    message = "block long, deleted boolean, part long, body binary"
    replies = materialize(ready.mapInArrow(_requests(parts), "part long, block long, deleted boolean, body binary").groupBy("part").applyInPandas(
        _sums, message))
    gathered = lambda which: ready.filter(which).join(
        replies.filter(which).groupBy("block").agg(F.collect_list(F.struct("part", "body")).alias("replies")), "block", "left")

    def left_out(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(rows):
            _, counts, contexts = _counts(r, parts, totals, without=True)
            yield pa.RecordBatch.from_arrays([pa.array([pack(*[narrow(x) for x in (*counts, *contexts)])], pa.binary())], ["counts"])

    mixture = fit(materialize(gathered(F.col("deleted")).mapInArrow(left_out, "counts binary")), totals, rounds)

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            id_arrow = batch.schema.field("docs").type.value_type.field("doc_id").type
            for r in _rows(iter([batch])):
                owned, counts, contexts = _counts(r, parts, totals)
                score_of = scores(mixture if totals.tokens else mixture._replace(one=0.0), counts, contexts, totals)
                del contexts
                base = np.log10((counts[0] + ADDED) / (totals.tokens + ADDED * (totals.known + 1)))
                of = np.repeat(np.arange(len(r["docs"])), [x["size"] for x in r["docs"]])[owned]
                add = lambda x=None: np.bincount(of, x, minlength=len(r["docs"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["row"] for x in r["docs"]], pa.int64()), pa.array([x["doc_id"] for x in r["docs"]], id_arrow),
                     pa.array([x["kind"] == HELD_OUT for x in r["docs"]]), pa.array(add()), pa.array(add(counts[0] > 0).astype(np.int64)),
                     pa.array(add(base)), pa.array(add(score_of))],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    by_block = gathered(F.lit(True)).mapInArrow(
        scored, f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return by_block.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
