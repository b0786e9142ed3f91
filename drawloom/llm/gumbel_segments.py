"""Distinct sampled segmentations: Gumbel top-k without replacement over the piece lattice.

A text's lattice is the chain of the lattices of its units (a run of the space
mark with what follows, which no piece crosses). Backward sums turn piece weights
into the probability of each next piece, so a segmentation is a path and its
probability the product along it. Perturbed A* search: the best perturbed value of
all paths is drawn first and goes to an ancestrally sampled path; every place
where the others part from that path is one open subproblem, whose best value is a
Gumbel at the logarithm of its total probability, truncated at the value of the
path it parts from. The subproblem of greatest value gives the next path and new subproblems. The values come in
falling order, so the first k paths are a sample without replacement, and the value
of the next subproblem is the threshold for the scores of inclusion.

All draws are hashes of the row key, so results do not depend on how rows are
dealt. Tasks work through all rows of a batch at once and prepare
each distinct unit of a batch once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.common import batch, ddl, keyed, pieces, raw, table
from drawloom.llm.names import mix, ranges

SPACE = "▁"
_STEP = 0x9E3779B97F4A7C15
_SAMPLE = pa.schema([
    ("id", pa.int64()), ("sample", pa.int32()), ("ids", pa.binary()), ("n_pieces", pa.int64()), ("log_prob", pa.float64()), ("value", pa.float64()), ("log_inclusion", pa.float64()),
])


class Vocabulary:
    """Pieces of a SentencePiece model with log weights.

    Scores of unigram models are log probabilities and are taken times `alpha`.
    Merge vocabularies score pieces by rank only; their weight is that of
    a Zipf law, -alpha * log(2 + rank).
    """

    def __init__(self, path: str, alpha: float = 1.0):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(len(sp)) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
        scores = np.array([sp.get_score(i) for i in plain])
        by_rank = bool(len(scores)) and (scores == np.round(scores)).all()
        weight = -alpha * np.log(2 - scores) if by_rank else alpha * scores
        self.weight = {sp.id_to_piece(i): (i, float(w)) for i, w in zip(plain, weight)}
        self.longest = max(map(len, self.weight), default=1)
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(len(sp)) if sp.is_byte(i)}
        self.rare = float(weight.min()) - 10.0 if len(weight) else -10.0
        self.unknown = sp.unk_id()
        # by length: hashes of all beginnings of pieces, with the id (-1: no piece itself) and weight
        found: dict[int, dict[int, tuple[int, float]]] = {}
        for piece, (i, w) in self.weight.items():
            h = 0
            for length, c in enumerate(piece, 1):
                h = (h + ord(c) + 1) * _STEP % 2**64
                h ^= h >> 31
                if length == len(piece):
                    found.setdefault(length, {})[h] = (i, w)
                else:
                    found.setdefault(length, {}).setdefault(h, (-1, 0.0))
        last = np.array([2**64 - 1], np.uint64)  # so that a search ends
        self.nothing = (last, np.zeros(1 << 16, np.int64), np.array([-1]), np.zeros(1))
        self.by_length = {}
        for length, x in found.items():
            names = np.array(sorted(x), np.uint64)
            # with the place of the first hash of each 16 leading bits
            index = np.searchsorted(names, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
            self.by_length[length] = (np.append(names, last), index, np.array([*(x[int(h)][0] for h in names), -1]), np.array([*(x[int(h)][1] for h in names), 0.0]))
        self.whole_words = not any(SPACE in p.lstrip(SPACE) for p in self.weight)

    def single(self, c: str) -> list[int]:
        """Ids for a character that is no piece: its bytes, else the unknown id."""
        codes = [self.bytes.get(b) for b in c.encode()]
        return [self.unknown] if None in codes else codes


def _upward(values: np.ndarray, at: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each search the first place from `at` on with a value of at least `least`; a few steps each, in neighbouring places."""
    at = at.copy()
    todo = np.flatnonzero(values[at] < least)
    while len(todo):
        at[todo] += 1
        todo = todo[values[at[todo]] < least[todo]]
    return at


class _Lattice:
    """The edges of the given units' lattices: for each state (a place in a unit) the next pieces.

    Built for all units at once: substrings of one length are looked up by hash
    together, and the backward sums go from the ends of all units to their starts.
    """

    def __init__(self, vocab: Vocabulary, codes: np.ndarray, lens: np.ndarray):
        n, codes = len(codes), codes.astype(np.uint64)
        unit_end = np.repeat(np.cumsum(lens), lens)
        left = unit_end - np.arange(n)  # characters to the end of the unit
        state = np.arange(n) + np.repeat(np.arange(len(lens)), lens)  # each unit has an end state too
        self.start = np.cumsum(lens + 1) - lens - 1
        at, h = np.arange(n), np.zeros(n, np.uint64)
        found, count_at = [], np.zeros(n, np.int64)
        for length in range(1, min(vocab.longest, int(lens.max()) if len(lens) else 0) + 1):
            ok = left[at] >= length
            at, h = at[ok], h[ok]
            if not len(at):
                break
            h = (h + codes[at + length - 1] + np.uint64(1)) * np.uint64(_STEP)
            h ^= h >> np.uint64(31)
            names, index, ids, weights = vocab.by_length.get(length, vocab.nothing)
            k = _upward(names, index[(h >> np.uint64(48)).astype(np.int64)], h)
            begins = names[k] == h
            piece = np.where(begins, ids[k], -1)
            hit = piece >= 0
            if length == 1:
                # a character that is no piece keeps the lattice whole, as its one id or -1 - its code
                odd, which = np.unique(codes[at[~hit]], return_inverse=True)
                alone = [vocab.single(chr(c)) for c in odd.tolist()]
                piece[~hit] = np.array([x[0] if len(x) == 1 else -1 - c for x, c in zip(alone, odd.tolist())], np.int64)[which]
                src, code, weight = at, piece, np.where(hit, weights[k], vocab.rare)
            else:
                src, code, weight = at[hit], piece[hit], weights[k[hit]]
            # each place has one edge of a length at most, so its rank among the place's edges is what it had before
            found.append((length, src, count_at[src], code, weight))
            count_at[src] += 1
            at, h = at[begins], h[begins]
        states = n + len(lens)
        count = np.zeros(states, np.int64)
        count[state] = count_at
        self.first = np.concatenate(([0], np.cumsum(count)))
        edges = int(self.first[-1])
        owner, self.target, self.code, weight = (np.empty(edges, t) for t in (np.int64, np.int64, np.int64, float))
        for length, src, rank, code, w in found:
            own = state[src]
            e = self.first[own] + rank
            owner[e], self.target[e], self.code[e], weight[e] = own, own + length, code, w
        total = np.zeros(states)
        by_left = np.argsort(left, kind="stable")
        edges_of = np.concatenate(([0], np.cumsum(np.bincount(left)))) if n else [0, 0]
        for d in range(1, len(edges_of) - 1):
            s = state[by_left[edges_of[d] : edges_of[d + 1]]]
            if not len(s):
                continue
            e = ranges(self.first[s], count[s])
            begin = np.cumsum(count[s]) - count[s]
            v = weight[e] + total[self.target[e]]
            top = np.maximum.reduceat(v, begin)
            total[s] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count[s])), begin))
        self.logp = np.minimum(weight + total[self.target] - total[owner], 0.0)
        p = np.exp(self.logp)
        # summed state by state, so that draws do not depend on what else is in the batch
        cum, more = p.copy(), np.flatnonzero(count > 1)
        rank = 1
        while len(more):
            e = self.first[more] + rank
            cum[e] += cum[e - 1]
            rank += 1
            more = more[count[more] > rank]
        np.minimum(cum, 1.0, out=cum)
        cum[self.first[1:][count > 0] - 1] = 1.0
        self.cum = cum
        with np.errstate(divide="ignore"):
            self.rest = np.log1p(-p)
        # the only edge of a state leaves nothing
        self.rest[np.repeat(count == 1, count)] = -np.inf
        self.ends = count == 0


def _hash(seed: np.ndarray, *parts) -> np.ndarray:
    for x in parts:
        seed = mix(seed, np.atleast_1d(np.asarray(x, np.uint64)))
    return seed


def _uniform(seed: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    return ((_hash(seed, *parts) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _walk(lat, seeds, r, unit_row, local, state, active):
    """Sample each active unit from its state to its end: the edges in order of unit, and how many each unit has."""
    first, target, cum, ends = lat.first, lat.target, lat.cum, lat.ends
    n, got = np.zeros(len(state), np.int64), []
    live = active[~ends[state[active]]] if len(active) else active
    s = state[live]
    base = mix(seeds[unit_row[live]], mix(local[live].astype(np.uint64), np.full(len(live), r + 1, np.uint64))) if len(live) else seeds[:0]
    while len(live):
        e = _upward(cum, first[s], _uniform(base, len(got)))
        got.append((live, e))
        n[live] = len(got)
        s = target[e]
        on = ~ends[s]
        live, s, base = live[on], s[on], base[on]
    out, at = np.zeros(int(n.sum()), np.int64), np.cumsum(n) - n
    for step, (units, e) in enumerate(got):
        out[at[units] + step] = e
    return out, n


def _split(vocab: Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all normalised texts; start, length and text of each unit."""
    normal = [vocab.sp.normalize(t) for t in texts]
    codes = np.frombuffer("".join(normal).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) for t in normal])
    space = codes == ord(SPACE)
    new = space & ~np.concatenate(([False], space[:-1])) if vocab.whole_words else np.zeros(len(codes), bool)
    some = [e - len(t) for e, t in zip(ends.tolist(), normal) if t]
    new[some] = True
    begin = np.flatnonzero(new)
    return codes, begin, np.diff(np.append(begin, len(codes))), np.searchsorted(ends, begin, "right")


def sample_rows(texts: list[str], seeds: np.ndarray, vocab: Vocabulary, k: int) -> list[list[tuple]]:
    """For each text up to k tuples (ids, log_prob, value, log_inclusion), values falling."""
    codes, begin, size, unit_row = _split(vocab, texts)
    # units are told apart by a hash of their characters
    place = np.arange(len(codes)) - np.repeat(begin, size)
    power = np.cumprod(np.full(int(size.max()) + 1 if len(size) else 1, _STEP, np.uint64))
    spread = mix(codes.astype(np.uint64), np.full(len(codes), 8, np.uint64)) * power[place]
    names = mix(np.add.reduceat(spread, begin), size.astype(np.uint64)) if len(begin) else np.empty(0, np.uint64)
    _, sample, kind = np.unique(names, return_index=True, return_inverse=True)
    lat = _Lattice(vocab, codes[ranges(begin[sample], size[sample])], size[sample])
    first, target, logp, rest, piece = lat.first, lat.target, lat.logp, lat.rest, lat.code
    rows = len(texts)
    n_units = np.bincount(unit_row, minlength=rows)
    row_unit = np.cumsum(n_units) - n_units
    # units are numbered within their row, so that draws do not depend on the batch
    start = lat.start[kind] if len(kind) else kind
    local = np.arange(len(start)) - row_unit[unit_row] if len(start) else start
    paths: list[dict] = []
    top = -np.log(-np.log(_uniform(seeds, 0xA)))

    def finish(r, edges, unit, value, offset, before, left, alive):
        """A path with log probability and the values of its subproblems. It holds its own edges only: those from place `offset`, before which its log probability is `before`."""
        row = unit_row[unit]
        count = np.bincount(row, minlength=rows)
        end = np.cumsum(count)
        begin = end - count
        step = logp[edges]
        lp = np.concatenate(([0.0], np.cumsum(step)))
        shift = before - lp[begin]
        lp_before = lp[:-1] + shift[row]
        mu = lp_before + rest[edges]
        if r:  # what is left at the place where the row's path parted
            j = begin[alive]
            mu[j] = lp_before[j] + left[alive]
        # A value is at most mu + 38 and at least min(value, mu - 4) - 1, as the draws are multiples of 2**-54.
        # At most k of a row's values are ever taken, so places that the k greatest mu surely beat need none.
        least = np.full(rows, -np.inf)
        for i, b, n in zip(range(rows), begin.tolist(), count.tolist()):
            if n > k:
                least[i] = np.partition(mu[b : b + n], n - k)[n - k]
        least = np.minimum(value, least - 4.0) - 39.0
        some = np.flatnonzero((mu >= least[row]) & np.isfinite(mu))
        near, place = row[some], some + (offset - begin)[row[some]]
        g = np.log(-np.log(_uniform(_hash(seeds, 0xB, r)[near], place)))
        values = np.full(len(edges), -np.inf)
        values[some] = -np.logaddexp(-value[near], g - mu[some])
        return {"edges": edges, "unit": unit, "begin": begin, "count": count, "values": values, "log_prob": lp[end] + shift, "value": value, "alive": alive, "lp_before": lp_before, "offset": offset}

    def best_of(path, some, best, at):
        """Greatest subproblem value of the given rows and its place among the path's own edges, into best and at."""
        v = path["values"]
        for i, b, n in zip(some.tolist(), path["begin"][some].tolist(), path["count"][some].tolist()):
            if n:
                j = int(v[b : b + n].argmax())
                best[i], at[i] = v[b + j], j

    def bests_of(path):
        best, at = np.full(rows, -np.inf), np.zeros(rows, np.int64)
        best_of(path, np.flatnonzero(path["alive"]), best, at)
        return best, at

    every = np.arange(len(start))
    edges, n = _walk(lat, seeds, 0, unit_row, local, start, every)
    paths.append(finish(0, edges, np.repeat(every, n), top, np.zeros(rows, np.int64), np.zeros(rows), None, np.ones(rows, bool)))
    parents = [np.zeros(rows, np.int64)]
    taken: list[dict[int, list[int]]] = [{}]  # by path: row -> edges used at its first own place
    bests = [bests_of(paths[0])]
    threshold = np.full(rows, -np.inf)
    for r in range(1, k + 1):
        stack = np.stack([b[0] for b in bests])
        which = stack.argmax(0)
        value = stack.max(0)
        if r == k:
            threshold = value
            break
        alive = value > -np.inf
        state, offset, before, left = start.copy(), np.zeros(rows, np.int64), np.zeros(rows), np.full(rows, -np.inf)
        used, todo, new = {}, [], []
        draw = _uniform(seeds, 0xC, r)
        for i in np.flatnonzero(alive).tolist():
            w = which[i]
            q = paths[w]
            place = int(bests[w][1][i])
            at = int(q["begin"][i]) + place
            old = int(q["edges"][at])
            gone = [*taken[w].get(i, ()), old] if place == 0 else [old]
            s = int(np.searchsorted(first, old, "right")) - 1
            options = [e for e in range(int(first[s]), int(first[s + 1])) if e not in gone]
            chance = [math.exp(x) for x in logp[options].tolist()]
            x, n_less = float(draw[i]) * math.fsum(chance), 0
            while n_less < len(options) - 1 and chance[n_less] < x:
                x -= chance[n_less]
                n_less += 1
            e = options[n_less]
            others = math.fsum(chance[:n_less] + chance[n_less + 1 :])
            if others > 0:
                left[i] = math.log(others)
            used[i] = gone
            offset[i], before[i] = q["offset"][i] + place, q["lp_before"][at]
            q["values"][at] = -np.inf
            u = int(q["unit"][at])
            new.append((u, e))
            state[u] = target[e]
            todo.append(np.arange(u, int(row_unit[i] + n_units[i])))
        on = np.flatnonzero(alive)
        for w in set(which[on].tolist()):
            best_of(paths[w], on[which[on] == w], *bests[w])
        active = np.concatenate(todo) if todo else np.empty(0, np.int64)
        more, n = _walk(lat, seeds, r, unit_row, local, state, active)
        # by row: the new edge and what was sampled after it
        unit = np.repeat(active, n[active])
        head = np.searchsorted(unit_row[unit], on)
        edges = np.insert(more, head, [e for _, e in new])
        unit = np.insert(unit, head, [u for u, _ in new])
        paths.append(finish(r, edges, unit, np.where(alive, value, 0.0), offset, before, left, alive))
        parents.append(which)
        taken.append(used)
        bests.append(bests_of(paths[-1]))
    out: list[list[tuple]] = [[] for _ in range(rows)]
    whole: list[list[np.ndarray | None]] = []
    for path, parent in zip(paths, parents):
        code = piece[path["edges"]]
        whole.append([None] * rows)
        for i in np.flatnonzero(path["alive"]).tolist():
            b, z = int(path["begin"][i]), int(path["begin"][i] + path["count"][i])
            ids = code[b:z]
            if path["offset"][i]:
                ids = np.concatenate((whole[parent[i]][i][: path["offset"][i]], ids))
            whole[-1][i] = ids
            if (ids < 0).any():
                ids = np.array([x for c in ids.tolist() for x in ((c,) if c >= 0 else vocab.single(chr(-1 - c)))], np.int64)
            lp = float(path["log_prob"][i])
            d = lp - float(threshold[i])
            out[i].append((ids.astype(np.uint32), lp, float(path["value"][i]), _log_inclusion(d)))
    return out


def _log_inclusion(d: float) -> float:
    """log(1 - exp(-exp(d))): d is the log probability less the threshold."""
    if d == math.inf or d > 5:
        return 0.0 if d == math.inf else math.log1p(-math.exp(-math.exp(min(d, 700))))
    return math.log(-math.expm1(-math.exp(d))) if d > -30 else d


def _samples(path, alpha, k, seed):
    def run(batches):
        vocab = Vocabulary(path, alpha)
        for b in pieces(batches, size=1 << 19):
            keys = [b.column(c).to_numpy().view(np.uint64) for c in ("k1", "k2")]
            seeds = mix(mix(keys[0], keys[1]), np.full(b.num_rows, seed, np.uint64))
            rows = []
            for i, found in zip(b.column("id").to_pylist(), sample_rows([t.decode() for t in raw(b.column("text"))], seeds, vocab, k)):
                rows += [(i, n + 1, ids.tobytes(), len(ids), lp, value, inclusion) for n, (ids, lp, value, inclusion) in enumerate(found)]
            yield batch(_SAMPLE, *zip(*rows))

    return run


def sample_segmentations(df: DataFrame, model: str, k: int = 2, alpha: float = 1.0, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to k rows per input row: id, sample (1 is the greatest value), ids (unsigned 32-bit little-endian piece ids), n_pieces, log_prob, value, log_inclusion.

    A row has fewer samples if its text has fewer segmentations; an empty or
    null text has one, of no pieces. Rows that repeat id and text get the same
    samples. Characters outside the vocabulary are their bytes, or the unknown
    piece if the model has none. Extra columns are not carried.
    """
    return keyed(df, id_col, text_col).mapInArrow(_samples(model, alpha, k, seed), ddl(_SAMPLE)).withColumnRenamed("id", id_col)


def decode(df: DataFrame, model: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """df with the text of each id list in out_col (null for null)."""

    @F.pandas_udf("string")
    def text(ids):
        import pandas as pd

        sp = Vocabulary(model).sp
        return pd.Series([None if x is None else sp.decode(np.frombuffer(x, np.uint32).tolist()) for x in ids], dtype=object)

    return df.withColumn(out_col, text(F.col(f"`{ids_col}`")))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: see sample_segmentations; four samples of each document, the pieces as their CRC-32."""
    out = sample_segmentations(table(spark, sf_dir, "documents"), model_path(), k=4)
    return out.select("doc_id", "sample", F.crc32("ids").alias("ids_crc32"), "n_pieces", F.round("log_prob", 6).alias("log_prob"), F.round("value", 6).alias("value"), F.round("log_inclusion", 6).alias("log_inclusion"))
