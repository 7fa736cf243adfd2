"""SentencePiece segmentations sampled without replacement, and their decoding.

All ways to cut a text into pieces of a vocabulary form a lattice. Adding Gumbel noise to the log-probability
of every path and taking the k largest draws k distinct paths without replacement. Nothing is enumerated: the
largest perturbed value below a lattice node is known before it is expanded (Gumbel noise with the node's total
mass, no larger than its parent's), so a best-first search whose bound is exact pops the paths in order:

* the best path is a plain draw from the lattice, and carries the root's value;
* all paths that leave it at one of its nodes form a set with known mass; the set's value is drawn below the
  path's, and the set goes to the frontier;
* the next path is drawn from the set with the largest value, which is then split in the same way.

A path's inclusion score is the probability that its value exceeds the (k+1)-th: 1 - exp(-exp(log_prob - threshold)).
For long texts it is tiny, so its logarithm is returned.

Pieces never cross words, so the lattice of a text is the chain of those of its words, and equal words share one.
Random numbers are a hash of row key, sample, place and purpose: samples depend on the key and the text alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.fertility import VOCABULARY, read_vocabulary
from shoplens.llm.tables import parts, pick

SAMPLES = 2
#: Rows and letters of the texts that are segmented together; a text alone may have more.
ROWS, CHUNK = 64, 50_000
#: Nodes whose sets are valued at a time, and how far above its log-mass a Gumbel value can be: the largest
#: number of ``_uniform`` is 1 - 2^-54.
BLOCK, HIGHEST = 512, 37.5
_MARK = "▁"


class Vocabulary:
    """Pieces of a model file as a trie, with the log-probability of each.

    Models of merges have ranks for scores, which say nothing of frequency but its order; a piece of rank r is
    taken to have a share of 1 / (r + 2) of all pieces, and a byte that of the last one.
    """

    def __init__(self, model: bytes) -> None:
        file = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = file.get_piece_size()
        special = [file.is_control(i) or file.is_unknown(i) or file.is_unused(i) for i in range(size)]
        self.byte_ids = np.full(256, -1, dtype=np.int64)
        self.bytes: list[bytes] = [b""] * size
        surfaces: dict[str, int] = {}
        for i in range(size):
            piece = file.id_to_piece(i)
            if file.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes([value])
            elif not special[i]:
                # The mark for a blank becomes a blank, so the mark itself, in a text, is spelt in bytes.
                surface = piece.replace(_MARK, " ")
                if " " in surface.lstrip(" ") or "\n" in surface[1:] or len(surface) > 1 and "\n" in surface:
                    raise ValueError(f"piece {piece!r} crosses words")
                surfaces[surface], self.bytes[i] = i, surface.encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no pieces for bytes")
        ranked = sorted(surfaces, key=lambda s: (-file.get_score(surfaces[s]), surfaces[s]))
        total = np.log(np.sum(1 / (np.arange(len(ranked)) + 2.0)))
        self.weight = np.zeros(size)
        for rank, surface in enumerate(ranked):
            self.weight[surfaces[surface]] = -np.log(rank + 2.0) - total
        self.weight[self.byte_ids] = -np.log(len(ranked) + 2.0) - total
        states, edges, piece_at = {"": 0}, {}, {}
        for surface, i in surfaces.items():
            for n in range(1, len(surface) + 1):
                state = states.setdefault(surface[:n], len(states))
                edges[states[surface[: n - 1]] << 21 | ord(surface[n - 1])] = state
            piece_at[state] = i
        # Edges by state and letter in a table that is a quarter full at most; where two meet, the later one moves on.
        bits = (4 * len(edges)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        slots = self._slot(np.array(list(edges), dtype=np.int64)).tolist()
        taken: dict[int, int] = {}
        for key, slot in zip(edges, slots):
            while slot in taken:
                slot = (slot + 1) & self.mask
            taken[slot] = key
        self.edge, self.to = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int64)
        self.edge[list(taken)] = list(taken.values())
        self.to[list(taken)] = [edges[key] for key in taken.values()]
        self.sizes = np.fromiter(map(len, self.bytes), dtype=np.int64, count=size)
        self.spelling = pa.array(self.bytes, type=pa.large_binary())
        self.piece = np.full(len(states), -1, dtype=np.int64)
        self.piece[list(piece_at)] = list(piece_at.values())

    def step(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The states that letters lead to, -1 where none."""
        keys = states << 21 | letters
        at = self._slot(keys)
        there = self.edge[at]
        out = np.where(there == keys, self.to[at], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            there = self.edge[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.to[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)


class Lattice:
    """Lattices of distinct words (UTF-8), end to end: arcs sorted by their node, with probabilities of the rest of the word.

    piece is the id of an arc, or -1 - letter for a letter that is spelt in bytes.
    """

    def __init__(self, words: pa.LargeBinaryArray, vocabulary: Vocabulary) -> None:
        cuts = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        spelt = words.buffers()[2].to_pybytes()[cuts[0] : cuts[-1]]
        heads = (np.frombuffer(spelt, dtype=np.uint8) & 0xC0) != 0x80
        self.sizes = sizes = np.diff(np.cumsum(np.append(0, heads))[cuts - cuts[0]])
        letters = np.frombuffer(spelt.decode().encode("utf-32-le"), dtype="<u4").astype(np.int64)
        # One node before each letter and one at each end.
        self.base = np.cumsum(sizes + 1) - sizes - 1
        node = np.arange(len(letters)) + np.repeat(np.arange(len(words)), sizes)
        # No edge bears the letter at an end.
        letter_of = np.full(int(sizes.sum()) + len(words), 0x1FFFFF, dtype=np.int64)
        letter_of[node] = letters
        end = np.repeat(self.base + sizes, sizes + 1)
        start, at, state = node, node, np.zeros(len(node), dtype=np.int64)
        arcs = []
        while len(start):
            state = vocabulary.step(state, letter_of[at])
            going = np.flatnonzero(state >= 0)
            start, at, state = start[going], at[going] + 1, state[going]
            piece = vocabulary.piece[state]
            ends = np.flatnonzero(piece >= 0)
            arcs.append((start[ends], at[ends], piece[ends], vocabulary.weight[piece[ends]]))
        single = np.zeros(len(letter_of), dtype=bool)
        if arcs:
            single[arcs[0][0]] = True
        spelt = node[~single[node]]
        code = letter_of[spelt]
        n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        one_byte = vocabulary.byte_ids[np.minimum(code, 0x7F)]
        arcs.append((spelt, spelt + 1, np.where(code > 0x7F, -1 - code, one_byte), n_bytes * vocabulary.weight[one_byte]))
        # Longest first: runs in the order of their nodes, which a stable sort only merges.
        start, to, piece, weight = (np.concatenate(c) for c in zip(*reversed(arcs)))
        order = np.argsort(start, kind="stable")
        start, self.to, self.piece, weight = start[order], to[order], piece[order], weight[order]
        # Mass below each node, from the ends of the words backwards, all words together.
        left = end[start] - start
        order = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        by_left, from_ = left[order], start[order]
        news = np.flatnonzero(np.diff(from_, prepend=-1) | np.diff(by_left, prepend=-1))
        cuts = np.flatnonzero(np.diff(by_left[news], prepend=-1))
        below = np.zeros(len(letter_of))
        for a, b in zip(cuts, [*cuts[1:], len(news)]):
            first, last = news[a], news[b] if b < len(news) else len(order)
            mine = order[first:last]
            below[from_[news[a:b]]] = np.logaddexp.reduceat(weight[mine] + below[self.to[mine]], news[a:b] - first)
        self.logp = np.minimum(weight + below[self.to] - below[start], 0.0)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(letter_of)))])
        self.start, self.end = start, end
        self.p = np.exp(self.logp)
        self.last = self.first[1:] - 1
        # Running sums inside each node, added up in the node's own order, so that they do not depend on its neighbours.
        self.upto = self.p.copy()
        at = self.first[:-1] + 1
        at = at[at <= self.last]
        while len(at):
            self.upto[at] += self.upto[at - 1]
            at = at + 1
            at = at[(at < len(start)) & (start[np.minimum(at, len(start) - 1)] == start[at - 1])]

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An arc out of each node, by its probability: the first whose running sum is above u."""
        at, last = self.first[nodes], self.last[nodes]
        open_ = np.flatnonzero((u >= self.upto[at]) & (at < last))
        while len(open_):
            at[open_] += 1
            here = at[open_]
            open_ = open_[(u[open_] >= self.upto[here]) & (here < last[open_])]
        return at


def _uniform(seed: np.ndarray, place: np.ndarray, purpose: int) -> np.ndarray:
    """Numbers above 0 and below 1 that hash their place (the finish of splitmix64)."""
    x = seed + (place.astype(np.uint64) * np.uint64(8) + np.uint64(purpose)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _below(mass: np.ndarray, cap: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values with these log-masses, drawn below their caps."""
    return mass - np.logaddexp(mass - cap, np.log(-np.log(u)))


def _seed(key: object, sample: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(f"{sample}:{key}".encode(), seed)


class _Text:
    """One text's samples so far, and the sets of paths that are left, largest value first."""

    def __init__(self, key: object, seed: int, first: int, last: int) -> None:
        self.key, self.seed, self.first, self.last = key, seed, first, last
        self.frontier: list[tuple] = []
        self.paths: list[tuple[np.ndarray, np.ndarray]] = []  # arcs, and the word that each is in
        self.values: list[float] = []


def _units(texts: list[str]) -> tuple[list[int], np.ndarray, pa.LargeBinaryArray]:
    """Where the words of each text end, the number of each word, and the distinct words.

    A blank goes before each text. A word is a line break, or blanks and what follows them up to the next blank or line break.
    """
    spelt = [b" " + x.encode() if x else b"" for x in texts]
    ends = np.cumsum([len(x) for x in spelt])
    data = b"".join(spelt)
    raw = np.frombuffer(data, dtype=np.uint8)
    blank, line = raw == 0x20, raw == 0x0A
    begins = line.copy()
    begins[1:] |= (blank[1:] & ~blank[:-1]) | (~blank[1:] & line[:-1])
    begins[np.append(0, ends)[:-1][np.diff(ends, prepend=0) > 0]] = True
    starts = np.flatnonzero(begins)
    cuts = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, cuts, pa.py_buffer(data)]).dictionary_encode()
    return np.searchsorted(starts, ends).tolist(), coded.indices.to_numpy().astype(np.int64), coded.dictionary


def sample_chunk(texts: list[str], keys: list, vocabulary: Vocabulary, k: int, seed: int) -> list[list[tuple]]:
    """For each text its samples: (ids, log_prob, value, log_inclusion), best value first."""
    ends, word, words = _units(texts)
    lattice = Lattice(words, vocabulary) if len(words) else None
    found = [_Text(key, seed, first, last) for key, first, last in zip(keys, [0, *ends[:-1]], ends)]
    lengths = lattice.sizes[word] if lattice else word
    place = np.cumsum(lengths) - lengths  # of each word's first letter; made the text's own below
    for t in found:
        if t.first < t.last:
            place[t.first : t.last] -= place[t.first]
    wanted = [(t, 0, None) for t in found if t.first < t.last]
    for sample in range(k):
        if not wanted:
            break
        _extend(wanted, sample, lattice, word, place, k)
        wanted = []
        for t in found:
            if sample + 1 < k and t.frontier:
                value, _, path, at, taken = heapq.heappop(t.frontier)
                t.values.append(-value)
                wanted.append((t, at, (path, taken)))
    return [_results(t, lattice, vocabulary) for t in found]


def _extend(wanted: list[tuple], sample: int, lattice: Lattice, word: np.ndarray, place: np.ndarray, k: int) -> None:
    """Draws one path for each text: as an earlier one up to a node, by another arc there, free from then on."""
    heads, walkers, forced = [], [], []
    for t, at, old in wanted:
        if old is None:
            t.values.append(float(-np.log(-np.log(_uniform(np.array([_seed(t.key, sample, t.seed)], dtype=np.uint64), np.zeros(1), 0)[0]))))
            heads.append((np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
            walkers.append(np.arange(t.first, t.last))
        else:
            arcs, of = t.paths[old[0]]
            heads.append((arcs[:at], of[:at]))
            walkers.append(np.arange(of[at], t.last))
        forced.append(None if old is None else (t.paths[old[0]][0][at], old[1]))
    seeds = np.array([_seed(t.key, sample, t.seed) for t, _, _ in wanted], dtype=np.uint64)
    counts = np.array([len(w) for w in walkers])
    of_word, of_text = np.concatenate(walkers), np.repeat(np.arange(len(wanted)), counts)
    first_walker = np.cumsum(counts) - counts
    node = lattice.base[word[of_word]].copy()
    base = node.copy()
    for i, force in enumerate(forced):
        if force is not None:
            node[first_walker[i]] = lattice.start[force[0]]
    stops = lattice.end[node]
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    going = np.arange(len(node))
    first_step = True
    while len(going):
        at = node[going]
        u = _uniform(seeds[of_text[going]], place[of_word[going]] + at - base[going], 1)
        arc = lattice.draw(at, u)
        if first_step:
            for i, force in enumerate(forced):
                if force is not None:
                    arc[first_walker[i]] = _other(lattice, int(at[first_walker[i]]), force[1], u[first_walker[i]])
            first_step = False
        steps.append((going, arc))
        node[going] = lattice.to[arc]
        going = going[node[going] < stops[going]]
    # Arcs in the order of the walkers, then of their steps.
    n = np.zeros(len(node), dtype=np.int64)
    for who, _ in steps:
        n[who] += 1
    offset = np.cumsum(n) - n
    arcs = np.empty(int(n.sum()), dtype=np.int64)
    for s, (who, arc) in enumerate(steps):
        arcs[offset[who] + s] = arc
    owner = np.repeat(np.arange(len(node)), n)
    cuts = np.append(offset[first_walker], len(arcs))
    for i, (t, at, old) in enumerate(wanted):
        mine = slice(cuts[i], cuts[i + 1])
        path, of = np.concatenate([heads[i][0], arcs[mine]]), np.concatenate([heads[i][1], of_word[owner[mine]]])
        t.paths.append((path, of))
    _leave(wanted, sample, lattice, word, place, seeds, k)


def _arcs_but(lattice: Lattice, node: int, taken: tuple[int, ...]) -> np.ndarray:
    arcs = np.arange(lattice.first[node], lattice.first[node + 1])
    for arc in taken:
        arcs = arcs[arcs != arc]
    return arcs


def _other(lattice: Lattice, node: int, taken: tuple[int, ...], u: float) -> int:
    """An arc out of a node, by its probability, but none of those taken."""
    arcs = _arcs_but(lattice, node, taken)
    upto = np.cumsum(lattice.p[arcs])
    return int(arcs[min(np.searchsorted(upto, u * upto[-1], side="right"), len(arcs) - 1)])


def _values(lattice: Lattice, arcs, of, before, rest_of, caps, seeds, word, place) -> np.ndarray:
    """Values of the sets of paths that leave the given ones at their arcs, -inf where there are none.

    before: log-mass of each arc's node along its path; rest_of: log-mass of the other arcs where it is not all but one.
    """
    nodes = lattice.start[arcs]
    several = np.flatnonzero(lattice.last[nodes] > lattice.first[nodes])
    rest = np.log(np.maximum(-np.expm1(lattice.logp[arcs[several]]), 1e-300))
    for i, mass in rest_of.items():
        rest[np.searchsorted(several, i)] = mass
    of = of[several]
    values = _below(before[several] + rest, caps[several], _uniform(seeds[several], place[of] + nodes[several] - lattice.base[word[of]], 2))
    out = np.full(len(arcs), -np.inf)
    out[several] = values
    return out


def _leave(wanted: list[tuple], sample: int, lattice: Lattice, word, place, seeds: np.ndarray, k: int) -> None:
    """Puts on each text's frontier the sets of paths that leave its newest path at a node, from the at-th on.

    Only the k + 1 largest values can matter. Mass falls along the path and a value is at most ``HIGHEST`` above
    the mass, so the search ends where that is below the k + 1 largest found: mostly in the first block, which
    all texts do together.
    """
    now = [(i, at, float(lattice.logp[t.paths[-1][0][:at]].sum())) for i, (t, at, _) in enumerate(wanted)]
    found: list[list] = [[] for _ in wanted]
    while now:
        parts = [wanted[i][0].paths[-1] for i, _, _ in now]
        arcs = [path[a : a + BLOCK] for (path, _), (_, a, _) in zip(parts, now)]
        ends = np.cumsum([len(x) for x in arcs])
        starts = ends - [len(x) for x in arcs]
        flat = np.concatenate(arcs)
        sizes = ends - starts
        logp = lattice.logp[flat]
        # Masses are added up text by text, so that a text's samples do not depend on those around it.
        before = np.concatenate([mass + np.cumsum(logp[a:b]) - logp[a:b] for (_, _, mass), a, b in zip(now, starts, ends)])
        special = {}
        for (i, a, _), start in zip(now, starts.tolist()):
            t, at, old = wanted[i]
            if old is not None and a == at:
                others = _arcs_but(lattice, lattice.start[flat[start]], (*old[1], int(flat[start])))
                special[start] = np.logaddexp.reduce(lattice.logp[others]) if len(others) else -np.inf
        of = np.concatenate([of[a : a + BLOCK] for (_, of), (_, a, _) in zip(parts, now)])
        caps = np.repeat([wanted[i][0].values[-1] for i, _, _ in now], sizes)
        values = _values(lattice, flat, of, before, special, caps, np.repeat(seeds[[i for i, _, _ in now]], sizes), word, place)
        later = []
        for (i, a, _), start, end in zip(now, starts.tolist(), ends.tolist()):
            mine = values[start:end]
            top = np.argpartition(mine, -k - 1)[-k - 1 :] if len(mine) > k + 1 else np.arange(len(mine))
            best = [(v, j + a) for v, j in zip(mine[top].tolist(), top.tolist()) if v > -np.inf]
            found[i] = heapq.nlargest(k + 1, found[i] + best) if found[i] else sorted(best, reverse=True)
            mass = float(before[end - 1] + logp[end - 1])
            if a + BLOCK < len(wanted[i][0].paths[-1][0]) and (len(found[i]) <= k or mass + HIGHEST >= found[i][-1][0]):
                later.append((i, a + BLOCK, mass))
        now = later
    for (t, at, old), sets in zip(wanted, found):
        path = t.paths[-1][0]
        for value, i in sets:
            taken = (*old[1], int(path[i])) if old is not None and i == at else (int(path[i]),)
            heapq.heappush(t.frontier, (-value, (sample, i), len(t.paths) - 1, i, taken))


def _results(t: _Text, lattice: Lattice | None, vocabulary: Vocabulary) -> list[tuple]:
    if t.first == t.last:
        return [(np.zeros(0, dtype=np.int32), 0.0, None, 0.0)]
    threshold = -t.frontier[0][0] if t.frontier else -np.inf
    out = []
    for (path, _), value in zip(t.paths, t.values):
        logp = float(lattice.logp[path].sum())
        gap = logp - threshold
        inclusion = 0.0 if gap > 30 else float(np.log(-np.expm1(-np.exp(gap)))) if gap > -30 else gap
        out.append((_ids(lattice.piece[path], vocabulary), logp, value, inclusion))
    return out


def _ids(pieces: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    spelt = np.flatnonzero(pieces < 0)
    if not len(spelt):
        return pieces.astype(np.int32)
    parts, done = [], 0
    for i in spelt.tolist():
        parts += [pieces[done:i], vocabulary.byte_ids[list(chr(-1 - pieces[i]).encode())]]
        done = i + 1
    return np.concatenate([*parts, pieces[done:]]).astype(np.int32)


def decode(ids, vocabulary: Vocabulary) -> str:
    """The text of a list of ids."""
    text = b"".join([vocabulary.bytes[i] for i in ids]).decode()
    return text[1:] if text else text


def decode_lists(lists: pa.Array, vocabulary: Vocabulary) -> pa.Array:
    """``decode`` of many lists of ids at once; null stays null. Bytes that are no UTF-8 are an error."""
    ids = lists.flatten()
    ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))
    cuts = np.cumsum(np.append(0, vocabulary.sizes[ids.to_numpy(zero_copy_only=False)]))[ends]
    spelt = vocabulary.spelling.take(ids).buffers()[2]
    texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(cuts.astype(np.int64)), spelt if spelt is not None else pa.py_buffer(b""))
    texts.validate(full=True)
    return pc.if_else(pc.is_valid(lists), pc.utf8_slice_codeunits(texts, 1), None).cast(pa.string())


@lru_cache(2)
def _vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def _chunks(texts: list[str]) -> Iterator[slice]:
    done = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > CHUNK:
            yield slice(done, i)
            done, size = i, 0
        size += len(x) + 1
    yield slice(done, len(texts))


def sampled(
    docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES, seed: int = 0, vocabulary: str = VOCABULARY,
    decoded: bool = False,
) -> DataFrame:
    """Up to ``samples`` distinct segmentations of every row: key, sample (from 1), ids, log_prob, value, log_inclusion.

    Texts with fewer segmentations have them all, with log_inclusion 0. A null or empty text has one, without pieces
    and without value. Repeated rows have the same samples; so have equal texts without key. An empty table gives no rows.
    With ``decoded`` there is a column decoded, too: what the ids say, read back while a slice's lists are in memory anyway.
    """
    rows = pick(docs, key=key, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    key_type = rows.schema["key"].dataType.simpleString()
    names = ["key", "sample", "ids", "log_prob", "value", "log_inclusion"] + ["decoded"] * decoded

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _vocabulary(shared.value)
        for batch in parts(batches, ROWS):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            keys = batch.column("key").to_pylist()
            for part in _chunks(texts):
                found = sample_chunk(texts[part], keys[part], known, samples, seed)
                n = [len(f) for f in found]
                flat = [s for f in found for s in f]
                ids = [s[0] for s in flat]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *ids])))
                where = pa.array(np.repeat(np.arange(part.start, part.stop), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(where), pa.array([i + 1 for f in found for i in range(len(f))], type=pa.int32()), lists,
                        *(pa.array([s[c] for s in flat], type=pa.float64()) for c in (1, 2, 3)), *([decode_lists(lists, known)] if decoded else []),
                    ],
                    names,
                )

    schema = f"key {key_type}, sample int, ids array<int>, log_prob double, value double, log_inclusion double"
    return rows.mapInArrow(cut, schema + ", decoded string" * decoded)


def decoder(spark, vocabulary: str = VOCABULARY):
    """A column function from lists of ids to texts; null stays null."""
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.arrow_udf(T.StringType())
    def of(lists: pa.Array) -> pa.Array:
        return decode_lists(lists, _vocabulary(shared.value))

    return of
