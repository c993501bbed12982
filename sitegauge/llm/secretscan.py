"""Secret scans by one deterministic automaton for all rules.

:mod:`sitegauge.llm.automaton` compiles the rules into transition arrays on
the driver (some thousand states, whatever the data); every task gets them by
broadcast. A task lays the texts of a batch one after another in a buffer of
bytes, cuts it into equal lanes and moves all lanes through the arrays side by
side, one byte a step: each byte is read once for all rules. A lane begins in
the start state; lanes whose neighbour ended in another state are moved again
from there until they meet the states they had, so long texts need no whole
pass of their own and cuts change no result.

The recorded states tell where matches end. Starts are found by walking a
rule's reversed automaton back from the end, to the earliest start behind the
rule's match before.

Defined results: a null or empty text has no spans. Spans are in code points,
end exclusive, ordered by start, then by the rules' order. Repeated rows are
scanned alike, extra columns aren't read, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.automaton import END, MATCH, Automaton, Rule, compile_rules
from sitegauge.llm.tables import read

#: The rules that the contract fixes, in its order.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", least=8),
    Rule("access", r"AKIA[A-Z0-9]+", least=12),
    Rule("hex", r"[0-9a-f]+", least=32),
)
#: Further rules: key files, signed web tokens, tokens of code hosts and of chat services.
MORE = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", shortest=40),
    Rule("host_token", r"gh[oprsu]_[A-Za-z0-9]+", shortest=40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", shortest=20),
)
#: Bytes of texts in one buffer (a longer text is a buffer of its own).
BUFFER = 8 << 20
#: Bytes of a lane.
LANE = 1 << 10


def states_after(symbols: np.ndarray, auto: Automaton) -> np.ndarray:
    """The automaton's state after every symbol of the buffer, from the start state."""
    lanes = -(-len(symbols) // LANE)
    padded = np.full(lanes * LANE, auto.classes[END], dtype=np.uint8)
    padded[:len(symbols)] = symbols
    steps = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    wide = auto.moves.shape[1]
    flat = (auto.moves * wide).ravel()      # states are kept as row offsets
    out = np.empty((LANE, lanes), dtype=np.int32)
    at = np.zeros(lanes, dtype=np.int32)
    for t in range(LANE):
        np.take(flat, at + steps[t], out=out[t], mode="clip")
        at = out[t]
    todo = np.arange(1, lanes)
    begins = np.zeros(lanes, dtype=np.int32)
    while len(todo):
        todo = todo[out[-1, todo - 1] != begins[todo]]
        at = begins[todo] = out[-1, todo - 1]
        again, t = todo, 0
        while len(again) and t < LANE:
            at = flat[at + steps[t, again]]
            other = at != out[t, again]
            out[t, again] = at
            again, at, t = again[other], at[other], t + 1
        todo = again + 1        # lanes that ended anew
        todo = todo[todo < lanes]
    return (out // wide).T.ravel()[:len(symbols)]


def _starts(symbols: np.ndarray, said: np.ndarray, ends: np.ndarray, back) -> np.ndarray:
    """The earliest start of each match that ends before ``ends``; ``said`` is what
    the states say of the rule."""
    moves, accepts = back
    still = [np.flatnonzero(row == i) for i, row in enumerate(moves)]
    start = ends.copy()
    which, at = np.arange(len(ends)), ends - 1
    state = np.ones(len(ends), dtype=np.int32)
    inside = np.ones(len(ends), dtype=bool)     # still in the run of states that match
    for _ in range(256):
        if not len(which):
            return start
        inside &= said[at] > 0
        # a byte where the rule had matched before: the search went on behind it
        go = inside | (said[at] == 0)
        state = np.where(go, moves[state, symbols[at]], 0)
        hit = accepts[state]
        start[which[hit]] = at[hit]
        go = (state != 0) & (at > 0)
        which, at, state, inside = which[go], at[go] - 1, state[go], inside[go]
    for w, a, q, run in zip(which.tolist(), at.tolist(), state.tolist(), inside.tolist()):
        # long matches: skip over the bytes on which the reversed automaton stays
        while q and a >= 0:
            if run and q != 0 and len(still[q]):
                size = 256
                while True:
                    low = max(0, a + 1 - size)
                    stays = np.isin(symbols[low:a + 1], still[q]) & (said[low:a + 1] > 0)
                    off = np.flatnonzero(~stays)
                    skip = a - low - (off[-1] if len(off) else -1)
                    if len(off) or low == 0:
                        break
                    size *= 4
                if skip:
                    if accepts[q]:
                        start[w] = a - skip + 1
                    a -= skip
                    continue
            run = run and said[a] > 0
            if not run and said[a]:
                break
            q = int(moves[q, symbols[a]])
            if accepts[q]:
                start[w] = a
            a -= 1
    return start


def find(buffer: np.ndarray, auto: Automaton) -> list[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) in bytes of every rule's reported matches, in a buffer of
    texts each ended by ``END``."""
    symbols = auto.classes[buffer]
    states = states_after(symbols, auto)
    any_match = (auto.says == MATCH).any(axis=1)
    # only states that match matter: most of a text has none
    hot = np.flatnonzero(any_match[states])
    found = []
    for r, rule in enumerate(auto.rules):
        here = hot[auto.says[states[hot], r] == MATCH]
        # texts end with END, so a match never ends the buffer
        ends = here[auto.says[states[here + 1], r] != MATCH] + 1
        if len(ends):
            starts = _starts(symbols, auto.says[:, r][states], ends, auto.backward[r])
            long = ends - starts >= rule.shortest
            starts, ends = starts[long], ends[long]
        else:
            starts = ends
        found.append((starts, ends))
    return found


def _buffers(sizes: np.ndarray):
    """Slices of rows whose texts fill a buffer."""
    first = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > BUFFER:
            yield first, i
            first, held = i, 0
        held += n + 1
    if first < len(sizes):
        yield first, len(sizes)


def spans_of(texts: pa.Array, auto: Automaton) -> dict[int, list[tuple[int, int, int]]]:
    """(start, rule number, end) in code points of the rows that have spans, ordered."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    found: dict[int, list] = {}
    for a, b in _buffers(sizes):
        n = sizes[a:b]
        base, total = offsets[a], int(offsets[b] - offsets[a])
        buffer = np.full(total + len(n), END, dtype=np.uint8)
        row_at = np.cumsum(n + 1) - (n + 1)
        for i in range(len(n)):
            buffer[row_at[i]:row_at[i] + n[i]] = raw[base:base + n[i]]
            base += n[i]
        hits = find(buffer, auto)
        if not any(len(e) for _, e in hits):
            continue
        heads = (buffer & 0xC0) != 0x80
        for r, (starts, ends) in enumerate(hits):
            rows = np.searchsorted(row_at, starts, side="right") - 1
            for row, s, e in zip(rows.tolist(), starts.tolist(), ends.tolist()):
                found.setdefault(a + row, []).append((s, r, e))
        points = np.concatenate([[0], np.cumsum(heads, dtype=np.int64)])
        for i in range(a, b):
            if i in found:
                zero = points[row_at[i - a]]
                found[i] = sorted((int(points[s] - zero), r, int(points[e] - zero)) for s, r, e in found[i])
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=BASE + MORE) -> DataFrame:
    """(id_col, spans array<struct<kind, start, end>>) of every row."""
    auto = docs.sparkSession.sparkContext.broadcast(compile_rules(tuple(rules)))
    kinds = pa.array([r.kind for r in rules], pa.string())
    parts = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            found = spans_of(batch.column(1), auto.value)
            rows = [found.get(i, ()) for i in range(batch.num_rows)]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
            flat = np.array([x for some in rows for x in some], dtype=np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays(
                [kinds.take(pa.array(flat[:, 1])), pa.array(flat[:, 0]), pa.array(flat[:, 2])], fields=list(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cuts), spans)], ["id", "spans"])

    kind = dict(docs.dtypes)[id_col]
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, spans array<struct<kind: string, start: long, end: long>>")
            .withColumnRenamed("id", id_col))


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Spans of all rules in every document, with a digest of the base rules' spans."""
    base = [r.kind for r in BASE]
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(kinds))
    found = scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base], F.sha2(joined(of(base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
