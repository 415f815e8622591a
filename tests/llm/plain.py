"""The operators' definitions in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import permutations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def digest(data):
    return hashlib.sha256(data).hexdigest()


def hits(docs, items):
    """doc_id to (n_words, n_hit, n_items, items_sha256)."""
    windows = []
    for item, text in items:
        words = ITEM_WORD.findall(folded(text))
        n = min(10, len(words))
        windows += [(item, words[i : i + n]) for i in range(len(words) - n + 1) if n]
    out = {}
    for doc_id, text in docs:
        words = ITEM_WORD.findall(folded(text))
        covered, found = set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    covered.update(range(i, i + len(window)))
                    found.add(item)
        named = sorted(str(i) for i in found if i is not None)
        out[doc_id] = len(words), len(covered), len(named), digest(",".join(named).encode())
    return out


def shingles(text):
    words = WORD.findall(folded(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_components(docs):
    """doc_id to (n_shingles, component_id)."""
    sets = {doc_id: shingles(text) for doc_id, text in docs}
    label = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in sets}


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def without_repeats(docs, width=100):
    """doc_id to (n_bytes, n_removed, n_spans, kept_sha256); ids are in order."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            if window in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = len(data), sum(gone), spans, digest(kept)
    return out


def without_boilerplate(docs, min_sites):
    """(doc_id, text) to the cleaned text; docs are (doc_id, text, site)."""
    sites, first = {}, {}
    for doc_id, text, site in docs:
        for pos, line in enumerate([] if text is None else text.split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                sites.setdefault(line, set()).update([site] if site is not None else [])
                place = (doc_id is not None, doc_id or 0, pos)
                first[line] = min(first.get(line, place), place)
    out = {}
    for doc_id, text, _ in docs:
        left = []
        for pos, line in enumerate([] if text is None else text.split("\n")):
            here = (doc_id is not None, doc_id or 0, pos)
            if len(sites.get(line, ())) < min_sites or first[line] == here:
                left.append(line)
        out[doc_id, text] = None if text is None else "\n".join(left)
    return out


def judged(url, rules):
    """host, path, rule, verdict by trying every rule."""
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = folded(re.match("[^/?#]*", rest)[0])
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
    best = None
    for action, rule in rules:
        of_host, _, of_path = rule.partition("/")
        if (host == of_host or host.endswith("." + of_host)) and path.startswith("/" + of_path):
            if best is None or len(rule) > len(best[0]):
                best = rule, action
    return host, path, best and best[0], best[1] if best else "allow"


def failures(docs, words=200, distinct=50, capitals=2):
    """Letters of the filters that each (doc_id, text) fails, in the order of ``docs``."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        found = WORD.findall(text)
        tests = {
            "A": len(found) < words,
            "B": 100 * len(set(found)) < distinct * len(found),
            "C": 100 * len(re.findall("[A-Z]", text)) > capitals * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t in docs),
        }
        out.append({letter for letter, fails in tests.items() if fails})
    return out


def interactions(docs, labels, **limits):
    """(part, order, step) to its counts; docs are (doc_id, text, part), labels (doc_id, quality,
    toxic). Every order is played through."""
    fails = failures([(i, t) for i, t, _ in docs], **limits)
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, is_toxic in labels if is_toxic == 1 and i is not None}
    out, shapley = {}, Counter()
    for part in {p or "" for _, _, p in docs}:
        mine = [(i, f) for (i, _, p), f in zip(docs, fails, strict=True) if (p or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = [f for _, f in mine if letter in f]
                shapley[part, letter] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(f == {letter} for f in failing),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
    return {(p, o, s): (*row, shapley[p, o[s - 1]]) for (p, o, s), row in out.items()}


def divergence(docs, min_docs=10, top=10):
    """Rows of (lang, source, part, item, value, rank); docs are (text, lang, source)."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, spread = {}, {}
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        found = term.findall(folded(text))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        spread.setdefault(lang, Counter()).update(set(found))
    rows = []
    for lang, sources in counts.items():
        kept = sorted(t for t, n in spread[lang].items() if n >= min_docs)
        whole = Counter()
        for of_source in sources.values():
            whole.update(of_source)

        def shares(n, kept=kept):
            total = sum(n[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (n[t] + 2) // total for t in kept}

        def price(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(n) for s, n in sources.items()}
        q = shares(whole)
        for s in sources:
            pairs = [("pair", o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [("term", t, price(p[s][t], q[t])) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for found, most in ((pairs, None), (terms, top)):
                found = sorted(found, key=lambda r: (-r[2], r[1].encode()))[:most]
                rows += [(lang, s, *r, rank) for rank, r in enumerate(found, 1)]
    return sorted(rows)


def without_passages(docs, window=13):
    """(doc_id, text) to (n_words, n_removed, kept_sha256)."""
    first = {}
    split = [(doc_id, text, WORD.findall(text or "")) for doc_id, text in docs]
    for doc_id, _, words in split:
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            said = tuple(words[i : i + window])
            first[said] = min(first.get(said, doc_id), doc_id)
    out = {}
    for doc_id, text, words in split:
        gone = set()
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            if first[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id, text] = len(words), len(gone), digest(kept.encode())
    return out
