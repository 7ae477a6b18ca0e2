"""Plain versions of the numbered queries, written from their contracts, for small tables."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import re
import zlib

import xxhash

sha = lambda b: hashlib.sha256(b).hexdigest()
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")


def op1(docs):
    texts = [(t or "").encode() for _, t in docs]
    seen = collections.Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(t), sum(gone), runs, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def op2(pages):
    same = collections.defaultdict(list)
    for p, _, h in pages:
        same[h or ""].append(p)
    out = []
    for p, _, h in pages:
        body = (h or "").encode()
        ids = [i for i in same[h or ""] if i is not None]
        refers = max(ids) if ids and len(same[h or ""]) > 1 and p != max(ids) else None
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers))
    return out


def op3(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = SPACED.findall(t)
        c = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {k for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACED.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside), failed))
    return out


def op3_kept(text, base_failed, most_covered, most_longest, least):
    """The verdict from all repeats of `least` words or more, pair by pair of places."""
    if base_failed:
        return False
    w = SPACED.findall(text or "")
    inside, longest = set(), 0
    for i in range(len(w)):
        for j in range(i):
            if w[i] != w[j] or (j and w[i - 1] == w[j - 1]):
                continue
            n = 0
            while i + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= least:
                inside.update(range(i, i + n), range(j, j + n))
                longest = max(longest, n)
    chars = sum(map(len, w))
    return sum(len(w[k]) for k in inside) <= most_covered * max(chars, 1) and longest <= most_longest * len(w)


def op4(docs, phrases, templates, threshold):
    out = []
    for d, t in docs:
        w = PLAIN.findall(lower(t))
        places = [(i, label) for p, label in phrases for k in [p.split()] for i in range(len(w)) if w[i : i + len(k)] == k]
        similar = {}
        for label, text in templates:
            words, m = set(text.split()), len(text.split())
            for a in range(0, len(w), m):
                have = set(w[a : a + 2 * m])
                if len(have & words) >= threshold * len(words) - 1e-9:
                    similar[label] = max(similar.get(label, 0), len(have & words) / len(words))
        base = {label for _, label in places}
        at = [i for i, _ in places]
        score = 1.0 if places else max(similar.values(), default=0.0)
        out.append((d, len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(similar))), score))
    return out


def op5(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = PLAIN.findall(lower(t))
        for k in range(max(1, len(w) - 9)):
            if w:
                windows[tuple(w[k : k + 10])].add(i)
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w = PLAIN.findall(lower(t))
        hit, own = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    own |= found - {None}
                    hit.update(range(i, i + n))
        out.append((d, len(w), len(hit), len(own), sha(",".join(sorted(map(str, own))).encode()), bool(hit)))
    return out


def op6(docs):
    prints = []
    for _, t in docs:
        w = lower(t).encode().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((d for (d, _), x in zip(docs, group) if x == g and d is not None), default=None) for g in group}
    return [(d, f"{p:016x}", least[g]) for (d, _), p, g in zip(docs, prints, group)]


def first_of_groups(docs):
    """One row of each component of fingerprints: the smallest doc_id, null last; rows alike in id and text are one."""
    prints = op6([(k, t) for k, (_, t) in enumerate(docs)])
    groups = collections.defaultdict(set)
    for (k, _, root), row in zip(prints, docs):
        groups[root].add(row)
    out = []
    for own in groups.values():
        least = min((d is None, d or 0) for d, _ in own)
        out.append({r for r in own if (r[0] is None, r[0] or 0) == least})
    return out


def op8(docs):
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = []
    for d, t in docs:
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        out.append((d, *(sum(k == n for _, k, _ in found) for n in range(3)), sha(base.encode())))
    return out


def held_out(d):
    return d is not None and zlib.crc32(str(d).encode()) % 5 == 0


def shrunk(groups, bound, weakest, strongest):
    """Prior strength by moments, and posterior means, of groups {name: (n, bad, prior)}."""
    many = [(n, b, p) for n, b, p in groups.values() if n > 1]
    scale = sum(p * (1 - p) * (n - 1) for n, _, p in many)
    share = (sum(n * (b / n - p) ** 2 for n, b, p in many) - sum(p * (1 - p) for _, _, p in many)) / scale if scale else None
    s = strongest if share is None or share <= 1 / (strongest + 1) else max(weakest, 1 / share - 1)
    return s, {k: (b + p * s) / (n + s) for k, (n, b, p) in groups.items()}


def op10_verdicts(pages, outcomes, rules, bound, threshold, weakest, strongest):
    decided = op10(pages, rules)
    known = collections.defaultdict(list)
    for page, bad in outcomes:
        if page is not None and bad is not None:
            known[page].append(bad)
    counts = [collections.defaultdict(lambda: [0, 0]) for _ in range(3)]
    levels = (lambda h: h, lambda h: ".".join(h.split(".")[-2:]), lambda h: h.split(".")[-1])
    for page, host, *_ in decided:
        for count, name in zip(counts, levels):
            own = count[name(host)]
            own[0] += len(known.get(page, ()))
            own[1] += sum(known.get(page, ()))
    n, bad = (sum(c[i] for c in counts[0].values()) for i in range(2))
    above = dict.fromkeys(counts[2], (bad + 1) / (n + 2))
    for level in (2, 1, 0):
        prior = {k: above[levels[level + 1](k)] if level < 2 else above[k] for k in counts[level]}
        s, above = shrunk({k: (*c, prior[k]) for k, c in counts[level].items()}, bound, weakest, strongest)
    low = {h for h, m in above.items() if m - bound * math.sqrt(m * (1 - m) / (counts[0][h][0] + s + 1)) > threshold}
    return [(*r[:4], r[4] or ("block" if r[1] in low else "allow")) for r in decided]


def op10(pages, rules):
    out = []
    for p, u, _ in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(r), r, v) for r, v in rules for h, _, rest in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + rest)]
        out.append((p, host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None))
    return out


def op11(vectors):
    kept = [(v, [max(-(1 << 27), min(1 << 27, math.floor(64 * x))) for x in e]) for v, e in vectors if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda v: sha(b"1:" + (b"" if v is None else str(v).encode()))
    centroids = [e for _, e in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:16]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for k in range(4):
        near = [min((apart(e, c), i) for i, c in enumerate(centroids)) for _, e in kept]
        for i in range(len(centroids) if k < 3 else 0):
            own = [e for (_, e), (_, j) in zip(kept, near) if i == j]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own)]
    within = collections.Counter()
    for d, i in near if kept else ():
        within[i] += d
    total = sum(within.values())
    return [(v, i, d, within[i], total, sha(",".join(map(str, centroids[i])).encode())) for (v, _), (d, i) in zip(kept, near if kept else ())]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def op12(docs, items, best=50):
    counted = [(d, collections.Counter(TERM.findall(lower(t)))) for d, t in docs]
    n = sum(bool(c) for _, c in counted)
    total = sum(c.total() for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 50 + 50 * c.total() * n // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(TERM.findall(lower(text))) if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(scored[:best], 1)]
    return out


def op13(docs, length=13):
    words = [SPACED.findall(t or "") for _, t in docs]
    least = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - length + 1 if d is not None else 0):
            key = tuple(w[i : i + length])
            least[key] = min(d, least.get(key, d))
    out = []
    for (d, _), w in zip(docs, words):
        gone = {k for i in range(len(w) - length + 1) if d is not None and least[tuple(w[i : i + length])] < d for k in range(i, i + length)}
        out.append((d, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return out
