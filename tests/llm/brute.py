"""Plain versions of the operators' definitions, for small inputs."""

import collections
import math
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def remainder(doc_id, mod):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % mod


def linked_components(rows, width=5, percent=80):
    """(id, size, component) of (id, text) rows."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append(frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = collections.defaultdict(list)
    for k, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in index[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[top(k)] = top(j)
        for g in s:
            index[g].append(k)
    members = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            members[top(k)].append(i)
    return [(i, len(sets[k]), min(members[top(k)], default=None)) for k, (i, _) in enumerate(rows)]


def base_spans(text):
    found = []
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit()]
            luhn = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            fine = [
                True,
                kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                16 <= len(digits) <= 19 and luhn,
                8 <= len(digits) <= 15,
            ]
            if fine[kind]:
                found.append((kind, *m.span()))
    return found


def edit_occurrence(pattern, text):
    """(fewest edits between pattern and a part of text, first end of such a part)."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row), row.index(min(row))


def suffix_tree_scores(rows, depth, least, smoothing):
    """{id: (held out, n_tokens, n_known, N, base, score)} of (id, text) rows with unique ids."""
    held = {i: remainder(i, 7) == 2 for i, _ in rows}
    texts = {i: words(t) + ["\n"] for i, t in rows}
    count = collections.Counter(w for i, t in texts.items() if not held[i] for w in t)
    total = sum(count.values())

    def root(w):
        return (count[w] + 1) / (total + len(count) + 1)

    def probability(before, w, levels):
        p = root(w)
        for size, (adds, left) in enumerate(levels, 1):
            context = tuple(before[-size:]) if len(before) >= size else None
            if context in left:
                p = adds.get((context, w), 0) + left[context] * p
        return p

    contexts = {("^",): sum(not h for h in held.values()), **{(w,): n for w, n in count.items() if n >= least and w != "\n"}}
    levels = []
    for size in range(1, depth + 1):
        pairs = collections.Counter()
        for i, t in texts.items():
            full = ["^"] + t
            for j in range(size, len(full)):
                context = tuple(full[j - size : j])
                if not held[i] and context in contexts and (count[full[j]] >= least or full[j] == "\n"):
                    pairs[context, full[j]] += 1
        by = collections.defaultdict(list)
        for (context, w), n in pairs.items():
            if n >= least:
                by[context].append((w, n))
        adds, left = {}, {}
        for context, following in by.items():
            named = sum(n for _, n in following)
            all_n = max(contexts[context], named)
            rest = (all_n - named + smoothing) / (all_n + smoothing)
            gain = (all_n - named) * math.log(rest)
            for w, n in following:
                suffix = probability(context, w, levels)
                gain += n * math.log((n / (all_n + smoothing) + rest * suffix) / suffix)
            if gain > 0.5 * len(following) * math.log(max(all_n, 2)):
                left[context] = rest
                adds |= {(context, w): n / (all_n + smoothing) for w, n in following}
        levels.append((adds, left))
        contexts = {(*c, w): n for (c, w), n in pairs.items() if n >= least and w != "\n"}
    out = {}
    for i, t in texts.items():
        full = ["^"] + t
        score = sum(math.log10(probability(full[:j], full[j], levels)) for j in range(1, len(full)))
        out[i] = (held[i], len(t), sum(count[w] > 0 for w in t), total, sum(math.log10(root(w)) for w in t), score)
    return out
