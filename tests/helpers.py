"""Brute-force versions of the change-log queries, over lists of dictionaries."""

from __future__ import annotations

import random
from collections import defaultdict

OPLOG_SCHEMA = (
    "seq long, tx_id string, node long, key string, op string, value string, committed boolean"
)


def random_oplog(seed: int, size: int = 150, keys: int = 5, txs: int = 12) -> list[dict]:
    """A short log in which one key and one transaction hold about a third of all rows."""
    rng = random.Random(seed)
    aborted = {f"t{i}" for i in range(txs) if rng.random() < 0.25}
    rows = []
    for seq in range(size):
        tx = "t0" if rng.random() < 0.3 else f"t{min(txs - 1, seq * txs // size + rng.randrange(3))}"
        key = "k0" if rng.random() < 0.3 else f"k{rng.randrange(keys)}"
        op = rng.choice(["put", "put", "delete", "read", "read", "read"])
        rows.append(
            {
                "seq": seq,
                "tx_id": tx,
                "node": int(key[1:]) % 2,
                "key": key,
                "op": op,
                "value": None if op == "delete" else str(rng.randrange(3)),
                "committed": tx not in aborted,
            }
        )
    return rows


def frame(spark, rows):
    names = [part.split()[0] for part in OPLOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], OPLOG_SCHEMA)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def spans(rows):
    found = {}
    for r in rows:
        a, z, ok = found.get(r["tx_id"], (r["seq"], r["seq"], True))
        found[r["tx_id"]] = (min(a, r["seq"]), max(z, r["seq"]), ok and r["committed"])
    return found


def slot(r):
    return r["node"], r["key"]


def changelog_apply(rows):
    """Play the log: buffer per transaction, apply the buffer at the commit point."""
    span, buffers, data = spans(rows), defaultdict(dict), {}
    for r in rows:
        tx = r["tx_id"]
        if r["op"] != "read":
            buffers[tx][slot(r)] = r["value"] if r["op"] == "put" else None
        if r["seq"] == span[tx][1] and span[tx][2]:
            data.update(buffers[tx])
    return sorted((n, k, v) for (n, k), v in data.items() if v is not None)


def resolve_reads(rows):
    span, buffers, data, out = spans(rows), defaultdict(dict), {}, []
    for r in rows:
        tx = r["tx_id"]
        if r["op"] == "read":
            own = buffers[tx]
            value = own[slot(r)] if slot(r) in own else data.get(slot(r))
            out.append((r["seq"], tx, *slot(r), value or ""))
        else:
            buffers[tx][slot(r)] = r["value"] if r["op"] == "put" else None
        if r["seq"] == span[tx][1] and span[tx][2]:
            data.update(buffers[tx])
    return sorted(out)


def lock_conflicts(rows):
    span, first = spans(rows), {}
    for r in rows:
        first.setdefault((r["tx_id"], *slot(r)), r["seq"])
    return sorted(
        (n, k, a, b)
        for (a, n, k), start in first.items()
        for (b, m, l), other in first.items()
        if (n, k) == (m, l) and a != b and start < other <= span[a][1]
    )


def _touched(rows, wanted):
    return {(r["tx_id"], *slot(r)) for r in rows if wanted(r["op"])}


def write_conflicts(rows):
    span, writes = spans(rows), _touched(rows, lambda op: op != "read")
    return sorted(
        (n, k, a, b)
        for a, n, k in writes
        for b, m, l in writes
        if (n, k) == (m, l) and span[a][0] < span[b][0] <= span[a][1]
    )


def write_skew_pairs(rows):
    span = spans(rows)
    reads, writes = _touched(rows, lambda op: op == "read"), _touched(rows, lambda op: op != "read")
    at = lambda touched, tx: {(n, k) for t, n, k in touched if t == tx}
    return sorted(
        (a, b)
        for a in span
        for b in span
        if a < b
        and span[a][2] and span[b][2]
        and span[a][0] <= span[b][1] and span[b][0] <= span[a][1]
        and at(reads, a) & at(writes, b)
        and at(reads, b) & at(writes, a)
        and not at(writes, a) & at(writes, b)
    )


def dirty_reads(rows):
    span = spans(rows)
    return sorted(
        (*slot(r), r["value"], r["tx_id"], r["seq"], w["tx_id"], w["seq"])
        for r in rows
        for w in rows
        if r["op"] == "read" and w["op"] == "put"
        and r["tx_id"] != w["tx_id"] and slot(r) == slot(w) and r["value"] == w["value"]
        and w["seq"] < r["seq"] <= span[w["tx_id"]][1]
    )


def dirty_reads_by_writer(rows):
    span, last = spans(rows), {}
    for r in rows:
        for w in rows:
            if (
                r["op"] == "read" and w["op"] == "put"
                and r["tx_id"] != w["tx_id"] and slot(r) == slot(w) and r["value"] == w["value"]
                and w["seq"] < r["seq"] <= span[w["tx_id"]][1]
            ):
                last[(*slot(r), r["value"], r["tx_id"], r["seq"], w["tx_id"])] = w["seq"]
    return sorted((*k, seq) for k, seq in last.items())


def non_repeatable_reads(rows):
    seen, wrote = defaultdict(set), set()
    for r in rows:
        place = (r["tx_id"], *slot(r))
        if r["op"] == "read":
            seen[place].add(r["value"] or "")
        else:
            wrote.add(place)
    return sorted((*p, len(v)) for p, v in seen.items() if len(v) > 1 and p not in wrote)


def phantom_reads(rows):
    counts = defaultdict(list)
    for r in rows:
        if r["op"] == "read":
            counts[r["tx_id"], r["node"]].append(
                sum(
                    w["op"] == "put" and w["node"] == r["node"]
                    and w["tx_id"] != r["tx_id"] and w["seq"] <= r["seq"]
                    for w in rows
                )
            )
    return sorted((*p, min(n), max(n)) for p, n in counts.items() if min(n) != max(n))
