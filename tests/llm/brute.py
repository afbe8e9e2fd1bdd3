"""Plain, slow versions of the numbered operators for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def repeated_passages(rows, window=13):
    """rows of (doc_id, text) -> {doc_id: (n_words, n_removed, sha256)}"""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, k=5):
    w = words((text or "").encode().lower().decode())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(rows, k=5, percent=75):
    """rows of (doc_id, text) -> {doc_id: (n_shingles, component_id, kept)}"""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    pairs = {(a, b) for own in by.values() for a in own for b in own if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def top_products(rows, k=5, every=50):
    """rows of (vec_id, vector) -> sorted (query_id, rank, vec_id, score)"""
    import math
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % every:
            continue
        best = sorted((-sum(x * y for x, y in zip(q, v)), j)
                      for b, (j, v) in enumerate(ok) if b != a)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def url_parts(url):
    """url -> (host, path, rule, verdict or None)"""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.encode().lower().decode()
    fits = [(len(h + p), h + p, v) for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def url_templates(urls):
    """urls -> {(host, path): (template, verdict, purity)}, a host's tree at a time"""
    hosts, out = defaultdict(lambda: defaultdict(list)), {}
    for u in urls:
        host, path, _, verdict = url_parts(u)
        hosts[host][path].append(verdict)

    def differs(part, n, whole, total):
        share = whole / total
        spread = share * (1 - share) * (1 / n + 1 / total)
        return spread > 0 and abs(part / n - share) >= 2.58 * spread ** 0.5

    def count(paths, own):
        labels = [v for p in paths for v in own[p]]
        return len(labels), labels.count("block"), labels.count("allow")

    def grow(paths, depth, name, own, done):
        """paths: {path: segments}"""
        branches, wild = defaultdict(dict), {}
        for p, parts in paths.items():
            if depth < len(parts):
                branches[parts[depth]][p] = parts
            else:
                done[name].append(p)
        total, blocked, allowed = count([p for b in branches.values() for p in b], own)
        for seg, branch in branches.items():
            n, b, a = count(branch, own)
            if ((b or a or (n >= 5 and n >= 0.02 * total))
                    and (differs(b, n, blocked, total) or differs(a, n, allowed, total))):
                grow(branch, depth + 1, f"{name}/{seg}", own, done)
            else:
                wild.update(branch)
        if wild:
            grow(wild, depth + 1, f"{name}/*", own, done)

    for host, own in hosts.items():
        done = defaultdict(list)
        grow({p: re.sub("^/", "", p).split("/") for p in own}, 0, "", own, done)
        for name, paths in done.items():
            n, b, _ = count(paths, own)
            purity = (b + 2) / (n + 4)
            for p in paths:
                out[host, p] = (name, own[p][0] or ("block" if purity >= 0.7 else "allow"), purity)
    return out


def edited(rows):
    """rows of (doc_id, text) -> {doc_id: (n_chars, sha256 of the edited text)}"""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        n, nxt = len(t) // 4, rows[(k + 1) % len(rows)][1]
        new = t[:len(t) - n] + nxt[:n]
        out[i] = (len(t), hashlib.sha256(new.encode()).hexdigest())
    return out


def mix_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """{source: words} -> {source: target}, by handing out the excess again and again"""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        over = 0.0
        for s in sorted(free, key=order.index):
            target[s] += left * weight[s] / total
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                over += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                free.discard(s)
        left = over
    return target


def hard_negatives(rows, positives=5, negatives=3, every=50):
    """rows of (vec_id, vector, label) -> sorted result rows of the miner"""
    import math
    ok = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows
          if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, label) in enumerate(ok):
        if i % every:
            continue
        by = [(-sum(a * b for a, b in zip(v, w)), j, own) for m, (j, w, own) in enumerate(ok)
              if m != k]
        best = sorted((s, j) for s, j, own in by if own == label)[:positives]
        for p, j in best:
            inside = sorted((s, n) for s, n, own in by
                            if own != label and 50 * -p <= 100 * -s <= 95 * -p)
            out += [(i, j, rank, n, -p, -s)
                    for rank, (s, n) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def captures(rows, least=100):
    """rows of (page_id, url, html) -> (page_id, type, bytes, digest, refers_to)"""
    out, first = [], {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            first[data] = min(first.get(data, i), i)
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        again = to is not None and to != i
        out.append((i, "revisit" if again else "response", len(data),
                    hashlib.sha256(data).hexdigest(), to if again else None))
    return out


def runs(w, min_length=24, exponent=3):
    """(start, length, period) of every run, by comparing words q apart"""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            s, length = i - q, j - i + q
            if j > i and length >= max(min_length, exponent * q) and all(
                    any(w[x] != w[x - d] for x in range(s + d, j)) for d in range(1, q)):
                out.append((s, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating(doc_id, text):
    import zlib
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def run_digest(doc_id, text):
    from fractions import Fraction
    w = repeating(doc_id, text)
    found = runs(w) if len(set(w)) < len(w) - 16 else []
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def xx(*values):
    """Spark's xxhash64 of (value, kind) pairs: i(nt), l(ong) or s(tring)"""
    import struct
    import xxhash
    seed = 42
    for value, kind in values:
        if value is not None:
            data = value.encode() if kind == "s" else struct.pack("<" + {"i": "i", "l": "q"}[kind], value)
            seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed - 2 ** 64 if seed >= 2 ** 63 else seed


def mix(rows, block=128, shard=1024, seed=0, cap=2, rounds=3, share=(7, 8), draw=None):
    """rows of (doc_id, text, source), ids unique -> {doc_id: words taken}.
    ``draw`` (round, slot, weight) replaces the hashed draw of a slot."""
    import math
    draw = draw or (lambda turn, k, weight: xx((seed, "i"), ("slot", "s"), (turn, "i"), (k, "l"))
                    % weight)
    size = {i: len(words(t)) for i, t, _ in rows}
    total = defaultdict(int)
    for i, _, s in rows:
        total[s] += size[i]
    target = mix_targets(total)
    order = sorted((s for s in total if s is not None)) + ([None] if None in total else [])
    blocks = {s: -(-total[s] // block) for s in order if total[s]}
    quota = {s: min(math.floor(target[s] * b / total[s] + 0.5), cap * b) for s, b in blocks.items()}
    slots = rest = sum(quota.values())
    taken = dict.fromkeys(quota, 0)
    for turn in range(rounds):
        lack = [(s, quota[s] - taken[s]) for s in quota if quota[s] > taken[s]]
        weight = sum(n for _, n in lack)
        n = rest if turn == rounds - 1 else rest * share[0] // share[1]
        if not weight or not n:
            continue
        bounds, owner = [], []
        for s, k in lack:
            bounds.append((bounds[-1] if bounds else 0) + k)
            owner.append(s)
        import bisect
        for k in range(n):
            s = owner[bisect.bisect_right(bounds, draw(turn, k, weight))]
            taken[s] += 1
        taken = {s: min(k, cap * blocks[s]) for s, k in taken.items()}
        rest = slots - sum(taken.values())

    def permuted(x, n, *key):
        for r in range(1, 9):
            mirror = (xx(*key, (r, "i")) % n - x) % n
            if xx(*key, (r, "i"), (max(x, mirror), "l"), (1, "i")) & 1:
                x = mirror
        return x
    times = defaultdict(int)
    for s, k in taken.items():
        for n in range(k):
            key = ((seed, "i"), ("\x00null" if s is None else s, "s"), (n // blocks[s], "l"))
            times[s, permuted(n % blocks[s], blocks[s], *key)] += 1
    out = {}
    for s in order:
        at = 0
        own = [(i, t or "") for i, t, x in rows if x == s]
        for h, i in sorted((xx((seed, "i"), (i, "l"), (xx((t, "s")), "l")), i) for i, t in own):
            out[i] = sum(times[s, w // block] for w in range(at, at + size[i]))
            at += size[i]
    return out
