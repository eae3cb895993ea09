"""Plain versions of the operators: slow, in one process, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


def components(nodes, links) -> dict:
    """Smallest node that links reach."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def exact(docs) -> dict:
    """id -> keep_id, group_size, kept, sha"""
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    return {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), sha(t or "")) for i, t in docs}


def tokens(docs, tokenizer) -> dict:
    """id -> number, ids as bytes, decoded text"""
    out = {}
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        out[i] = (ids, np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False))
    return out


def stored(docs, tokenizer) -> dict:
    out, start = {}, 0
    for i, t in sorted(docs):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def mix_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """By sharing again and again until nobody is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        rest = sum(sizes.values()) - sum(capped.values())
        over = [s for s in free if rest * weight[s] / sum(weight[f] for f in free) > most * sizes[s]]
        if not over:
            return {s: capped[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in names}
        capped |= {s: float(most * sizes[s]) for s in over}


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
                    r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text) -> tuple:
    """counts, digest of base spans"""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ("assign", "access", "hex")
    joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(k == j for _, k, _ in spans) for j in range(3)), sha(joined), joined)


def private(text) -> tuple:
    text = text or ""
    kinds = ("email", "ip", "card", "phone")
    spans = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        if 13 <= len(d) <= 19:
            total = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d)))
            if total % 10 == 0:
                spans.append((2, *m.span()))
    spans += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    joined = ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in sorted(spans))
    return (*(sum(k == j for k, _, _ in spans) for j in range(4)), sha(joined), joined)


def shingle_sets(docs) -> dict:
    out = {}
    for i, t in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(lowered)
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def near(docs) -> dict:
    """id -> n_shingles, component_id"""
    sets = shingle_sets(docs)
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    shared: dict = defaultdict(int)
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    of = components(sets, links)
    return {i: (len(sets[i]), of[i]) for i in sets}


def embeddings(rows, cosine=0.98) -> dict:
    """id -> n_links, component_id; rows of (id, vector, label)"""
    good = {}
    for i, v, label in rows:
        if label is None or v is None or any(x is None for x in v):
            continue
        v = np.array(v, float)
        if len(v) and np.isfinite(v).all() and v.any():
            good[i] = (v, label)
    ids = sorted(good)
    links = []
    for k, a in enumerate(ids):
        va, la = good[a]
        for b in ids[k + 1:]:
            vb, lb = good[b]
            if la == lb and len(va) == len(vb):
                if (va * vb).sum() / (np.sqrt((va * va).sum()) * np.sqrt((vb * vb).sum())) >= cosine:
                    links.append((a, b))
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    of = components([r[0] for r in rows], links)
    return {r[0]: (count[r[0]], of[r[0]]) for r in rows}


def repeats(docs, length=200) -> dict:
    """id -> n_bytes, n_removed, n_spans, sha of the rest"""
    seen: dict = defaultdict(int)
    data = {i: (t or "").encode() for i, t in docs}
    for b in data.values():
        for k in range(len(b) - length + 1):
            seen[hashlib.blake2b(b[k:k + length], digest_size=12).digest()] += 1
    out = {}
    for i, b in data.items():
        hit = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if seen[hashlib.blake2b(b[k:k + length], digest_size=12).digest()] > 1:
                hit[k] += 1
                hit[k + length] -= 1
        gone = np.cumsum(hit)[:len(b)] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, sha(bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MARK = re.compile(r"<<(/?optional|words (\d+) (\d+))>>")


def license_words(text) -> list[str]:
    return LICENSE_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def template_tree(template: str) -> list:
    """Words, ('optional', nodes) and ('words', least, most)."""
    stack, place = [[]], 0
    for mark in MARK.finditer(template):
        stack[-1] += license_words(template[place:mark.start()])
        place = mark.end()
        if mark[1] == "optional":
            stack.append([])
        elif mark[1] == "/optional":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            stack[-1].append(("words", int(mark[2]), int(mark[3])))
    return stack[0] + license_words(template[place:])


def template_ends(nodes: list, words: list[str], start: int) -> set[int]:
    """Where a match of the nodes that starts at ``start`` can end."""
    ends = {start}
    for node in nodes:
        if isinstance(node, str):
            ends = {e + 1 for e in ends if e < len(words) and words[e] == node}
        elif node[0] == "optional":
            ends |= {x for e in ends for x in template_ends(node[1], words, e)}
        else:
            ends = {e + k for e in ends for k in range(node[1], node[2] + 1) if e + k <= len(words)}
    return ends


def licenses(text, templates) -> list[tuple[str, bool, int, int]]:
    """(label, base, start, end), the longest match of every template at every place"""
    words = license_words(text)
    trees = [(t.label, t.base, template_tree(t.text)) for t in templates]
    found = set()
    for start in range(len(words)):
        for label, base, tree in trees:
            ends = template_ends(tree, words, start)
            if ends:
                found.add((start, max(ends), label, base))
    return [(x, b, s, e) for s, e, x, b in sorted(found)]


def mined(rows, is_anchor, positives=5, negatives=5, low=80, high=100, scale=256) -> list[tuple]:
    """Of (id, label, vector): anchor, positive, rank, negative, both scores; rows stand for themselves."""
    usable = [(k, i, x, [int(np.floor(float(c) * scale)) for c in v]) for k, (i, x, v) in enumerate(rows)
              if i is not None and x is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for k, anchor, label, v in usable:
        if not is_anchor(anchor):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i, x == label) for m, i, x, w in usable
                         if m != k and len(w) == len(v)), key=lambda s: s[:2])
        for p, name, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p]
            out += [(anchor, name, rank, s[1], -p, -s[0]) for rank, s in enumerate(inside[:negatives], 1)]
    return sorted(out)


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merkle(nodes: list[str], fanout: int = 8) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node its (siblings before, siblings after), level by level."""
    place, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for leaf, at in enumerate(place):
            run = at // fanout * fanout
            paths[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        place = [at // fanout for at in place]
    return nodes[0], paths


def manifest(docs, fanout: int = 8) -> list[tuple]:
    """Of (id, part, fields, claimed fields): id, leaf, subroot, root, proof, folded root, verified"""
    parts = defaultdict(list)
    for i, part, fields, claimed in docs:
        parts[part].append((i is not None, i, sha("".join(map(field, fields))), sha("".join(map(field, claimed)))))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for name in names:
        parts[name].sort(key=lambda r: (r[0], r[1] or 0, r[2]))
        trees[name] = merkle([r[2] for r in parts[name]], fanout)
    root, tops = merkle([trees[n][0] for n in names], fanout) if names else (None, [])
    out = []
    for name, top in zip(names, tops):
        subroot, paths = trees[name]
        for (_, i, leaf, claimed), path in zip(parts[name], paths):
            acc = claimed
            for before, after in path + top:
                acc = sha(before + acc + after)
            proof = sha("".join(b + a for b, a in path + top))
            out.append((i, leaf, subroot, root, proof, acc, acc == root))
    return sorted(out, key=str)
