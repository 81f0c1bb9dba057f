"""Brute-force versions of the operators, shared by the tests of this folder."""

import hashlib
import itertools
import re

import numpy as np
import public_tokenizers
import xxhash


def plain_fingerprint(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints, max_bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= max_bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(prints))]


def plain_contamination(docs, items):
    def cut(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for item, text in items:
        w = cut(text)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[s:s + 13]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def plain_best(pieces, text):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - pieces.longest), j):
            n = model.piece_to_id(text[i:j])
            if n == model.unk_id() or model.is_byte(n):
                if j - i > 1:
                    continue
                score = pieces.unknown
            else:
                score = model.get_score(n)
            if best[i][0] + score > best[j][0]:
                best[j] = (best[i][0] + score, i)
    cuts, j = [], len(text)
    while j:
        cuts.append(text[best[j][1]:j])
        j = best[j][1]
    return best[-1][0], cuts[::-1]


def plain_capacity(weights, shards):
    def needed(c):
        used, filled = 1, 0
        for w in weights:
            if w > c:
                return shards + 1
            if filled + w > c:
                used, filled = used + 1, 0
            filled += w
        return used
    return next(c for c in range(max(weights), sum(weights) + 1) if needed(c) <= shards)


def plain_alignment(a, b, a_bytes, b_bytes, texts):
    """Rows of the alignment (n_a, n_b, groups text, links) per text, and the counts of all links."""
    found, counts = [], {}
    for text in texts:
        wanted = (" " + (text or "")).encode()
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)) if text else ([], [])
        if not text or b"".join(a_bytes[i] for i in x) != wanted or b"".join(b_bytes[i] for i in y) != wanted:
            found.append((0, 0, "", []))
            continue
        ends = [list(itertools.accumulate(len(t[i]) for i in ids)) for t, ids in ((a_bytes, x), (b_bytes, y))]
        at = [{end: k + 1 for k, end in enumerate(e)} for e in ends]
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            u, v = at[0][end], at[1][end]
            groups.append(",".join(map(str, x[i:u])) + "|" + ",".join(map(str, y[j:v])))
            links.append((x[u - 1], y[v - 1]))
            i, j = u, v
        for link in links:
            counts[link] = counts.get(link, 0) + 1
        found.append((len(x), len(y), ";".join(groups), links))
    return found, counts


def plain_collocations(rows, support, per_language):
    """Collocations of (lang, text) rows by counting every phrase in a dict."""
    f, n = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] = n.get(lang, 0) + len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    key = lang, tuple(w[i:i + k])
                    f[key] = f.get(key, 0) + 1
    often = {k: a for k, a in f.items() if a >= support}
    out = []
    for (lang, w), a in often.items():
        if len(w) < 2 or any(len(x) == 3 and g == lang and w in (x[:2], x[1:]) and 2 * b >= a for (g, x), b in often.items() if len(w) == 2):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    result = []
    for lang, group in itertools.groupby(sorted(out), key=lambda r: r[0]):
        result += [(lang, i, r[3].decode(), *r[4:]) for i, r in enumerate(list(group)[:per_language], 1)]
    return result


def plain_call_ranks(calls: list[tuple]) -> dict[tuple, tuple | None]:
    """(turn, steps) of each (conv_id, call_id) by recursion over (conv_id, turn, call_id, name, arguments, after); None behind a cycle."""
    by = {(c[0], c[2]): c for c in calls}
    deps = {k: [(k[0], d) for d in (c[5] or []) if (k[0], d) in by] for k, c in by.items()}
    reach = {}
    for v in by:
        seen, todo = set(), list(deps[v])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += deps[x]
        reach[v] = seen
    ring = {v for v in by if v in reach[v]}
    known: dict[tuple, tuple | None] = {v: None for v in by if v in ring or reach[v] & ring}

    def rank(v):
        if v not in known:
            known[v] = max([(by[v][1], 0)] + [(t, steps + 1) for t, steps in map(rank, deps[v])])
        return known[v]
    return {v: rank(v) for v in by}
