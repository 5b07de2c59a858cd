"""Plain Python versions of the contracts: [(doc_id, text), ...] -> {doc_id: result}."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def words(text):
    return SPACES.findall(text or "")


def secrets(text):
    """n_assign, n_access, n_hex, base spans."""
    text = text or ""
    a = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    k = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    h = [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    spans = [f"{('assign', 'access', 'hex')[n]}:{s}:{e}" for s, n, e in sorted(a + k + h)]
    return len(a), len(k), len(h), spans


def entropy(value, window):
    best = 0.0
    for i in range(len(value) - window + 1):
        n = Counter(value[i:i + window])
        best = max(best, -sum(c / window * math.log2(c / window) for c in n.values()))
    return best


def substring_dedup(docs, size=50):
    first = defaultdict(set)
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - size + 1):
            first[tuple(w[i:i + size])].add(math.inf if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if min(first[tuple(w[i:i + size])]) < (math.inf if doc_id is None else doc_id):
                gone[i:i + size] = [True] * size
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def exact_dedup(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in docs:
        form = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        out.append((doc_id, min(groups[form])[2], len(groups[form]), sha(form)))
    return out


def fingerprint(text, k=3):
    w = words(lower(text or ""))
    if not w:
        return 0
    parts = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, bits=3):
    """[(doc_id, fp)] -> {doc_id: smallest id reachable}."""
    ids = [d for d, _ in fps]
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i, (a, x) in enumerate(fps):
        for b, y in fps[i + 1:]:
            if (x ^ y).bit_count() <= bits:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


def contamination(docs, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text or ""))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = word.findall(lower(text or ""))
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i:i + n]))
                if ids:
                    hit[i:i + n] = [True] * n
                    found |= ids
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), sum(hit), len(found), sha(",".join(found)), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def base_scores(docs, folds=5, held=1):
    def fold(d):
        return None if d is None else zlib.crc32(str(d).encode()) % folds
    counts = Counter()
    tokens = [words(lower(t or "")) + [None] for _, t in docs]
    for (d, _), t in zip(docs, tokens):
        if d is not None and fold(d) != held:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, _), t in zip(docs, tokens):
        out.append((d, fold(d) == held, len(t), sum(counts[x] > 0 for x in t), n,
                    sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)))
    return out


def jaccard(docs, size=5, percent=80):
    """[(doc_id, n_shingles, component_id)] by comparing every two sets that share a shingle."""
    sets = []
    for _, text in docs:
        w = words(lower(text or ""))
        sets.append(frozenset(" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    classes = defaultdict(list)
    for row, s in enumerate(sets):
        classes[s].append(row)
    keys, holders = list(classes), defaultdict(list)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(keys):
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(keys[j]) - c):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, s in enumerate(keys):
        if s:
            groups[find(i)] += classes[s]
    least = {row: min((docs[r][0] for r in rows if docs[r][0] is not None), default=None) for rows in groups.values() for row in rows}
    return [(docs[row][0], len(s), least[row] if s else docs[row][0]) for row, s in enumerate(sets)]


def merkle(rows):
    """Rows of documents as dicts -> [(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)]."""
    def leaf(r, text):
        fields = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
        return levels

    sources = defaultdict(list)
    for r in rows:
        changed = r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        sources[r["source"]].append((r["doc_id"], leaf(r, r["text"]), leaf(r, lower(r["text"]) if changed else r["text"])))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: tree([x[1] for x in sources[s]]) for s in order}
    top, out = tree([trees[s][-1][0] for s in order]), []
    for number, s in enumerate(order):
        for at, (doc_id, digest, now) in enumerate(sources[s]):
            proof = ""
            for levels, place in ((trees[s], at), (top, number)):
                for level in levels[:-1]:
                    run = level[place // 16 * 16:][:16]
                    before, after = run[:place % 16], run[place % 16 + 1:]
                    proof += "".join(before + after)
                    now = sha("".join([*before, now, *after]))
                    place //= 16
            out.append((doc_id, digest, trees[s][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return out


def trie(rows):
    """Rows of conversations as dicts -> the nodes in the order of the operator's columns."""
    told = defaultdict(list)
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            told[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, role, tie, text))
    told = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in told.items()}
    nodes, built = defaultdict(list), {}
    for c in told:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = told.get(int(c - math.fmod(c, 100)), [])[:h] + told[c][h:]
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0)
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(built[c]) == len(k))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(children[k]), leaves[k], saved[k], sha(ends)))
    return out


_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")


def random_looking(value, allow, classes, window=24):
    """Whether a window of one class reaches its entropy outside the allow-list's matches."""
    covered = set()
    for rule in allow:
        for m in re.finditer(rule, value):
            covered.update(range(*m.span()))
    for alphabet, least, alone in classes.values():
        for at in range(len(value) - window + 1):
            part = value[at:at + window]
            if not re.fullmatch(f"[{alphabet}]+", part) or covered & set(range(at, at + window)):
                continue
            h = -sum(c / window * math.log2(c / window) for c in Counter(part).values())
            groups = len(re.findall("[^0-9][0-9]", part))
            if h >= alone - 1e-9 or (h >= least - 1e-9 and groups >= 2):
                return True
    return False


def secret_spans(text, allow, classes):
    """Base spans and entropy spans, in their order."""
    text = text or ""
    base = [(int(a), ("assign", "access", "hex").index(k), int(b)) for k, a, b in (s.split(":") for s in secrets(text)[3])]
    found = []
    for m in _CANDIDATE.finditer(text):
        value, (start, end) = m[0], m.span()
        if not re.search("[A-Za-z]", value) or not re.search("[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]", value):
            continue
        if any(a < end and b > start for a, _, b in base) or not random_looking(value, allow, classes):
            continue
        found.append((start, 3, end))
    return [f"{('assign', 'access', 'hex', 'entropy')[k]}:{a}:{b}" for a, k, b in sorted(base + found)]
