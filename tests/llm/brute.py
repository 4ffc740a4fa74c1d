"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def repeats(seqs, W):
    """For each sequence the set of covered indices."""
    count = Counter(tuple(s[i:i + W]) for s in seqs for i in range(len(s) - W + 1))
    out = []
    for s in seqs:
        hit = set()
        for i in range(len(s) - W + 1):
            if count[tuple(s[i:i + W])] > 1:
                hit.update(range(i, i + W))
        out.append(hit)
    return out


def op5(docs, W=400):
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (d, _), t, hit in zip(docs, texts, repeats(texts, W)):
        kept = bytes(c for i, c in enumerate(t) if i not in hit)
        spans = sum(1 for i in hit if i - 1 not in hit)
        out.append((d, len(t), len(hit), spans, sha(kept)))
    return out


def op9(docs, W=35):
    seqs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    return [(d, len(s), len(hit), sha(" ".join(w for i, w in enumerate(s) if i not in hit)))
            for (d, _), s, hit in zip(docs, seqs, repeats(seqs, W))]


def op8(docs):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({(a, b) for a, b in zip(w, w[1:])} if len(w) > 1 else {tuple(w)} if w else set())
    comp = {d: d for d, _ in docs}
    ids = [d for d, _ in docs]

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    order = sorted((i for i in range(len(sets)) if sets[i]), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1:]:
            if 100 * len(sets[i]) < 80 * len(sets[j]):
                break
            inter = len(sets[i] & sets[j])
            if 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                a, b = find(ids[i]), find(ids[j])
                comp[max(a, b)] = min(a, b)
    return [(d, len(s), find(d), find(d) == d) for (d, _), s in zip(docs, sets)]


def op2(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[i:i + n]))):
                    found |= x
                    hit.update(range(i, i + n))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def op10_base(docs):
    out = []
    for d, t in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        rep = repeats([w], 3)[0]
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                    len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    return out


def op7_base(docs):
    kinds = [("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    out = []
    for d, t in docs:
        found = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, t or "") if ok(m)]
        n = Counter(x[2] for x in found)
        out.append((d, n["assign"], n["access"], n["hex"], sha(",".join(f"{x[2]}:{x[0]}:{x[3]}" for x in sorted(found)))))
    return out


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def op4_base(docs):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)]
    out = []
    for d, t in docs:
        found = [(k, m.start(), m.end(), name) for k, (name, p, ok) in enumerate(kinds) for m in re.finditer(p, t or "") if ok(m[0])]
        n = Counter(x[3] for x in found)
        out.append((d, n["email"], n["ip"], n["card"], n["phone"], sha(",".join(f"{x[3]}:{x[1]}:{x[2]}" for x in sorted(found)))))
    return out


def op11(rows, scale=4096, parts=8, entries=16, rounds=6, bound=1 << 28):
    """`rows`: (id, vector, label), all of one length once the odd ones are out."""
    import math
    ok = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) % parts == 0]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ok = [r for r in ok if len(r[1]) == len(ok[0][1])]
    x = [[max(-bound, min(bound, math.floor(scale * c))) for c in r[1]] for r in ok]
    w = len(x[0]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for v in x[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, y)), e) for e, y in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for v in x:
                own[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(c) for c in zip(*o)] if o else y for o, y in zip(own, books[p])]
    out = []
    for r, v in zip(ok, x):
        near = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), r[2]))
    total = Counter()
    for *_, error, label in out:
        total[label] += error
    digest = sha(",".join(str(c) for book in books for y in book for c in y))
    return [(d, code, error, total[label], digest) for d, code, error, label in out]


def op12(rows, k=20, every=20):
    """query id -> [(score, id)] of the nearest, all of them exact."""
    import math
    ok = {(r[0], tuple(x + 0.0 for x in r[1])) for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])}
    return {(q, v): sorted(((-sum(a * b for a, b in zip(v, u)), i) for i, u in ok if i != q and len(u) == len(v)))[:k]
            for q, v in ok if q % every == 0}


def op13(docs, items, k=10):
    import math
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    tfs = [(d, Counter(split(t))) for d, t in docs]
    df = Counter(w for _, tf in tfs for w in tf)
    n_all, length = sum(1 for _, tf in tfs if tf), sum(sum(tf.values()) for _, tf in tfs)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, tf in tfs:
            m = 10 + 90 * sum(tf.values()) * n_all // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m)) for w in set(split(text)) if tf[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:k])]
    return out
