"""Plain Python versions of the operators' results, for small tables."""

import hashlib
import re

import xxhash


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def fingerprint(text):
    w = words(low(text))
    shingles = [" ".join(w[j : j + 3]) for j in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """{id: smallest id reachable} from {id: fingerprint}."""
    parent = {i: i for i in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def cut(rows, width=20):
    """{id: (n_words, n_removed, kept)} from (id, text)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            if k in seen:
                gone[s : s + width] = [True] * width
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def lines(rows, least=20, docs=3):
    """{id: (n_lines, n_dropped, kept)} from (id, text)."""
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held.setdefault(key(x), set()).add(i)
    out = {}
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(held.get(key(x), ())) < docs or max(held[key(x)]) == i]
        out[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def bench_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))


def leaks(rows, items, span=10):
    """{id: (n_words, n_hit, sorted item ids)} from (id, text) and (item, text)."""
    windows = {}
    for item, t in items:
        w = bench_words(t)
        n = min(span, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(item))
    out = {}
    for i, t in rows:
        w = bench_words(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if own := windows.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out


def shares(sizes, weights=(1, 2, 3), most=3):
    """{source: target} from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    left, free, out = sum(sizes.values()), list(order), {}
    while free:
        whole = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / whole > most * sizes[s]]
        if not over:
            return out | {s: left * w[s] / whole for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    """(root, [siblings of each leaf from the leaf up, as (text before, text after)])."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for p, i in zip(paths, at):
            p.append((level[i - 1], "") if i % 2 else ("", level[i + 1] if i + 1 < len(level) else ""))
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def manifest(rows):
    """[(id, leaf, subroot, root, path)] from rows (id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], sha("".join(map(encoded, r)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([x for _, x in groups[g]]) for g in names]
    root, tops = tree([t[0] for t in trees]) if names else (None, [])
    return [(i, leaf, sub, root, path + top) for g, (sub, paths), top in zip(names, trees, tops) for (i, leaf), path in zip(groups[g], paths)]


def audit(rows, least=3, top=200):
    """[(lang, source, part, item, value, rank)] from rows (lang, source, text)."""
    df, count, groups = {}, {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.setdefault(lang, set()).add(source)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text))
        for t in set(terms):
            df[lang, t] = df.get((lang, t), 0) + 1
        for t in terms:
            count[lang, source, t] = count.get((lang, source, t), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in df.items() if x == lang and n >= least]
        n = {s: {t: count.get((lang, s, t), 0) for t in kept} for s in sources}
        n[None] = {t: sum(n[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(own.values()) + len(kept)) for t, c in own.items()} for s, own in n.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], p[None][t])) for t in kept if n[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def cut_bytes(rows, length=50):
    """[(id, n_bytes, n_removed, spans, kept)] from (id, text); a null id counts as the smallest."""
    order = lambda i: -(1 << 63) if i is None else i
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            least[s] = min(least.get(s, order(i)), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < order(i):
                gone[p : p + length] = [True] * length
        edge = [p for p in range(len(b) + 1) if (p < len(b) and gone[p]) != (p > 0 and gone[p - 1])]
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), list(zip(edge[::2], edge[1::2])), kept))
    return sorted(out, key=str)
