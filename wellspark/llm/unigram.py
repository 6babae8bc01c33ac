"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is taken as a blank and its characters, blanks standing for the marker of the vocabulary.
Pieces hold markers at their front only, so a text falls into chunks, each some blanks and what
follows up to the next blank, and the best pieces of a text are the best pieces of its chunks.
Each distinct chunk of a batch is solved once: the trie is walked from all places at a time, one
byte per step, and the best scores move from left to right through all chunks together. A
character that no piece stands for becomes its UTF-8 bytes, as byte pieces; in the sum of scores
it counts UNKNOWN below the least piece. At equal scores the longer last piece wins.

Vocabularies come from a model file of the sentencepiece library. Scores of a unigram model are
log probabilities and taken as they are. Those of a byte-pair model are ranks; as nothing may be
trained here, Zipf's law turns them into log probabilities.

Defined results: null and empty texts give no pieces and decode to the empty text. Every valid
text comes back unchanged; a literal marker sign is encoded in bytes, so it does, too. Text that
is not UTF-8 becomes U+FFFD on decoding; unknown ids decode to nothing. Rows are handled one by
one, and a column named like the result is replaced. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wellspark.llm import words as W
from wellspark.llm.rows import named, with_result

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
BLANK = 0x20
#: What a character without a piece scores below the least piece.
UNKNOWN = 10.0
#: Added to a rank in Zipf's law.
ZIPF_SHIFT = 2.7
#: Slots of the trie that are looked at together when a node is placed.
SEARCH = 256
#: Bytes of text whose distinct chunks are solved together.
BATCH_BYTES = 1 << 18
#: Rows that are decoded together.
DECODE_ROWS = 100

ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_byte_pieces", T.LongType()),
        T.StructField("log_score", T.DoubleType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


@dataclass
class Pieces:
    """A vocabulary as arrays: the trie over bytes, scores by id, bytes by id."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    scores: np.ndarray
    unknown: float
    byte_ids: np.ndarray
    is_byte: np.ndarray
    data: np.ndarray
    borders: np.ndarray


def load(model: str = MODEL) -> Pieces:
    """The vocabulary of a model file."""
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(processor.get_piece_size())
    names = [processor.id_to_piece(i) for i in ids]
    byte = [processor.is_byte(i) for i in ids]
    plain = [
        not (byte[i] or processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i))
        for i in ids
    ]
    scores = np.array([processor.get_score(i) for i in ids], dtype=np.float64)
    return vocabulary(names, byte, plain, scores)


def vocabulary(names: list[str], byte: list[bool], plain: list[bool], scores: np.ndarray) -> Pieces:
    """Arrays for the pieces ``names``; ``plain`` ones are matched, ``byte`` ones stand for bytes."""
    plain_ids = np.flatnonzero(plain)
    for i in plain_ids.tolist():
        if MARKER in names[i].lstrip(MARKER):
            raise ValueError(f"piece {names[i]!r} has a marker behind its front")
    ranks = scores[plain_ids]
    if (ranks == np.floor(ranks)).all():
        order = plain_ids[np.lexsort((plain_ids, -ranks))]
        weight = 1.0 / (np.arange(len(order)) + ZIPF_SHIFT)
        scores = scores.copy()
        scores[order] = np.log(weight / weight.sum())
    said = [n.replace(MARKER, " ").encode() if p else b"" for n, p in zip(names, plain)]
    byte_ids = np.full(256, -1, dtype=np.int32)
    for i in np.flatnonzero(byte).tolist():
        value = int(names[i][3:5], 16)
        byte_ids[value] = i
        said[i] = bytes([value])
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks byte pieces")
    base, check, piece = double_array({said[i]: i for i in plain_ids.tolist() if said[i]})
    borders = np.concatenate([[0], np.cumsum([len(s) for s in said])]).astype(np.int64)
    return Pieces(
        base, check, piece, scores, float(scores[plain_ids].min() - UNKNOWN), byte_ids,
        np.array(byte), np.frombuffer(b"".join(said), dtype=np.uint8), borders,
    )


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A trie: from state s a byte c leads to t = base[s] + c + 1 if check[t] is s; piece[t] is the
    id of the key that ends in t, or -1."""
    tree: list[dict[int, int]] = [{}]
    ends = {}
    for key, value in keys.items():
        node = 0
        for c in key:
            if c not in tree[node]:
                tree[node][c] = len(tree)
                tree.append({})
            node = tree[node][c]
        ends[node] = value
    # A state takes one slot, so this is more room than nodes can need where they lie close.
    size = 2 * len(tree) + (1 << 12)
    base, piece = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
    check, free = np.full(size, -1, dtype=np.int32), np.ones(size, dtype=bool)
    check[0], free[0] = 0, False
    state = {0: 0}
    # Where the last node of the same kind was placed; the next search goes on from there.
    hints: dict[int, int] = {}
    for node, children in enumerate(tree):
        if not children:
            continue
        # Nodes are numbered after their parents, so the state is known.
        s = state[node]
        steps = sorted(children)
        kind = -steps[0] if len(steps) == 1 else len(steps)
        at = hints.get(kind, 0)
        while True:
            if at + SEARCH + 260 >= len(free):
                more = len(free)
                base = np.append(base, np.zeros(more, dtype=np.int32))
                piece = np.append(piece, np.full(more, -1, dtype=np.int32))
                check = np.append(check, np.full(more, -1, dtype=np.int32))
                free = np.append(free, np.ones(more, dtype=bool))
            fits = free[at + steps[0] + 1 : at + steps[0] + 1 + SEARCH].copy()
            for c in steps[1:]:
                fits &= free[at + c + 1 : at + c + 1 + SEARCH]
            first = int(fits.argmax())
            if fits[first]:
                at += first
                break
            at += SEARCH
        base[s] = hints[kind] = at
        for c in steps:
            t = at + c + 1
            check[t], free[t] = s, False
            state[children[c]] = t
            piece[t] = ends.get(children[c], -1)
    # Any byte may be looked up from any state.
    used = max(int(np.flatnonzero(~free).max()), int(base.max())) + 260
    return base[:used], check[:used], piece[:used]


def matches(p: Pieces, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, id) of every piece found in ``data``; ``ends`` has the end of the chunk of
    each place."""
    place = np.arange(len(data))
    state = np.zeros(len(data), dtype=np.int32)
    found = []
    step = 0
    while len(place):
        to = p.base[state] + data[place + step].astype(np.int32) + 1
        good = p.check[to] == state
        place, state = place[good], to[good]
        step += 1
        ids = p.piece[state]
        hit = ids >= 0
        found.append((place[hit], np.full(int(hit.sum()), step), ids[hit]))
        more = place + step < ends[place]
        place, state = place[more], state[more]
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def solved(p: Pieces, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """For chunks of ``data`` that follow one another: piece ids, the first of each chunk, and
    the chunks' scores."""
    n = len(sizes)
    chunk = np.repeat(np.arange(n), sizes)
    ends = np.repeat(starts + sizes, sizes)
    place, length, ids = matches(p, data, ends)
    score = p.scores[ids]

    # Characters without a piece of their own.
    lead = (data & 0xC0) != 0x80
    lead[starts] = True
    char = np.flatnonzero(lead)
    char_size = np.diff(np.append(char, len(data)))
    size_at = np.zeros(len(data), dtype=np.int64)
    size_at[char] = char_size
    # Pieces are cut at characters, so a match begins and ends with one.
    own = np.zeros(len(data), dtype=bool)
    own[place[length == size_at[place]]] = True
    lone = char[~own[char]]
    place = np.concatenate([place, lone])
    length = np.concatenate([length, size_at[lone]])
    ids = np.concatenate([ids, np.full(len(lone), -1, dtype=ids.dtype)])
    score = np.concatenate([score, np.full(len(lone), p.unknown)])

    # A node before each byte and one after each chunk.
    within = place - starts[chunk[place]]
    node = place + chunk[place]
    first_node = starts + np.arange(n)
    best = np.full(len(data) + n, -np.inf)
    best[first_node] = 0.0
    edge = np.full(len(data) + n, -1, dtype=np.int64)
    # From left to right; of edges from one place the longer ones reach other nodes.
    order = np.argsort(within, kind="stable")
    borders = np.searchsorted(within[order], np.arange(int(sizes.max(initial=0)) + 1))
    for left, right in zip(borders[:-1].tolist(), borders[1:].tolist()):
        e = order[left:right]
        to = node[e] + length[e]
        reached = best[node[e]] + score[e]
        better = reached > best[to]
        to = to[better]
        best[to] = reached[better]
        edge[to] = e[better]

    # Backwards along the best edges, one piece of every chunk at a time.
    last_node = first_node + sizes
    total = best[last_node]
    at, owner = last_node, np.arange(n)
    taken = []
    while True:
        open_ = at > first_node[owner]
        at, owner = at[open_], owner[open_]
        if not len(at):
            break
        e = edge[at]
        taken.append(e)
        at = at - length[e]
    edges = np.concatenate(taken) if taken else np.zeros(0, dtype=np.int64)
    edges = edges[np.argsort(place[edges], kind="stable")]
    width = np.where(ids[edges] >= 0, 1, length[edges])
    out = np.repeat(ids[edges], width)
    offset = np.arange(len(out)) - np.repeat(np.cumsum(width) - width, width)
    as_bytes = out < 0
    source = np.repeat(place[edges], width) + offset
    out[as_bytes] = p.byte_ids[data[source[as_bytes]]]
    count = np.bincount(chunk[place[edges]], weights=width, minlength=n).astype(np.int64)
    return out.astype(np.int32), np.concatenate([[0], np.cumsum(count)]), total


def gathered(values: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of the ranges ``which`` one after another, and the ranges' sizes."""
    sizes = np.diff(first)[which]
    total = int(sizes.sum())
    at = np.arange(total) + np.repeat(first[which] - (np.cumsum(sizes) - sizes), sizes)
    return values[at], sizes


def encode(p: Pieces, texts: pa.Array) -> list:
    """The fields of ENCODED for each text."""
    data, borders = W.buffers(texts)
    filled = np.diff(borders) > 0
    # A blank before each text that is not empty.
    shift = np.cumsum(filled)
    spread = np.full(len(data) + int(filled.sum()), BLANK, dtype=np.uint8)
    rows = np.repeat(np.arange(len(texts)), np.diff(borders))
    spread[np.arange(len(data)) + shift[rows]] = data
    borders = borders + np.concatenate([[0], shift])
    data = spread
    # A chunk begins with each run of blanks; every text begins with one.
    blank = data == BLANK
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[borders[:-1][filled]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    keys = W.hashes(data, starts, ends)
    _, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
    # Each distinct chunk once, one after another.
    chunk_first = np.append(starts, len(data))
    body, sizes = gathered(data, chunk_first, sample)
    distinct_starts = np.cumsum(sizes) - sizes
    ids, first, total = solved(p, body, distinct_starts, sizes)
    out, widths = gathered(ids, first, inverse)
    text_chunks = np.searchsorted(starts, borders)
    piece_at = np.concatenate([[0], np.cumsum(widths)])[text_chunks]
    scores = np.concatenate([[0.0], np.cumsum(total[inverse])])
    byte_before = np.concatenate([[0], np.cumsum(p.is_byte[out])])
    return [
        pa.ListArray.from_arrays(pa.array(piece_at.astype(np.int32)), pa.array(out)),
        np.diff(byte_before[piece_at]),
        np.diff(scores[text_chunks]),
        [a == b for a, b in zip(said_bytes(p, piece_at, out), texts.cast(pa.binary()).to_pylist())],
    ]


def said_bytes(p: Pieces, first: np.ndarray, values: np.ndarray) -> list[bytes]:
    """The bytes that each row of ids stands for, without the blank in front."""
    inside = (values >= 0) & (values < len(p.borders) - 1)
    values = np.where(inside, values, 0)
    data, sizes = gathered(p.data, p.borders, values)
    if not inside.all():
        data = data[np.repeat(inside, sizes)]
        sizes = np.where(inside, sizes, 0)
    at = np.concatenate([[0], np.cumsum(sizes)])[first]
    said = data.tobytes()
    return [said[a + (said[a : a + 1] == b" " and a < b) : b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def decode(p: Pieces, ids: pa.ListArray) -> list[str]:
    """The text of each row of ids; null rows and null ids stand for nothing."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy()
    values = pa.compute.fill_null(ids.flatten(), -1).to_numpy()
    first = np.concatenate([[0], np.cumsum(sizes)])
    return [said.decode("utf-8", "replace") for said in said_bytes(p, first, values)]


def encoded(
    docs: DataFrame,
    *,
    model: str = MODEL,
    text: str = "text",
    into: str = "pieces",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the struct ``into``: piece ids, how many of them
    are bytes, the log score of the best segmentation, and whether decoding gives the text."""
    sent = docs.sparkSession.sparkContext.broadcast(load(model))

    def compute(texts: pa.Array) -> list:
        return encode(sent.value, texts)

    return with_result(docs, into, ENCODED, compute, text=text, keep=keep, limit=BATCH_BYTES)


def decoded(
    frame: DataFrame, *, model: str = MODEL, ids: str = "ids", into: str = "text"
) -> DataFrame:
    """``frame`` with the text ``into`` of its piece ids; null ids are no pieces."""
    sent = frame.sparkSession.sparkContext.broadcast(load(model))
    kept = [c for c in frame.columns if c != into]
    place = kept.index(ids)
    schema = T.StructType([frame.schema[c] for c in kept] + [T.StructField(into, T.StringType())])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(first, DECODE_ROWS)
                said = pa.array(decode(sent.value, part.column(place)), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, said], [*kept, into])

    return frame.select(*[named(c).alias(f"c{i}") for i, c in enumerate(kept)]).mapInArrow(run, schema)
