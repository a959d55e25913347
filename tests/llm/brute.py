"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def shingle_set(text, n=5):
    found = [w.lower() for w in words(text)]
    if not found:
        return set()
    if len(found) < n:
        return {tuple(found)}
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def least_of_components(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_components(docs, percent=80):
    """docs: {doc_id: text} -> {doc_id: (n_shingles, component_id)}"""
    sets = {d: shingle_set(t) for d, t in docs.items()}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = defaultdict(int)
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                common[a, b] += 1
    links = [(a, b) for (a, b), c in common.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]
    least = least_of_components(docs, links)
    return {d: (len(sets[d]), least[d]) for d in docs}


def repeated_bytes(docs, width=200):
    """docs: {doc_id: text} -> {doc_id: (n_bytes, n_removed, n_spans, sha256 of what is left)}"""
    raw = {d: (t or "").encode() for d, t in docs.items()}
    count = defaultdict(int)
    for b in raw.values():
        for i in range(len(b) - width + 1):
            count[b[i : i + width]] += 1
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        left = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


SECRET_PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def secret_base(text):
    """[(kind, start, end)] by start, then kind."""
    out = []
    for kind, pattern in SECRET_PATTERNS:
        for m in pattern.finditer(text or ""):
            size = len(m.group(2)) if kind == "assign" else len(m.group())
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((kind, m.start(), m.end()))
    order = [k for k, _ in SECRET_PATTERNS]
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


def edited_texts(docs):
    """docs: [(doc_id, text)] with distinct ids -> {doc_id: edited text}"""
    docs = sorted((d, t or "") for d, t in docs)
    out = {}
    for i, (d, t) in enumerate(docs):
        cut = len(t) // 4
        out[d] = t[: len(t) - cut] + docs[(i + 1) % len(docs)][1][:cut]
    return out


PII_PATTERNS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_base(text):
    """[(kind, start, end)] by start, then kind."""
    out = []
    for kind, pattern in PII_PATTERNS:
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if fine:
                out.append((kind, m.start(), m.end()))
    order = [k for k, _ in PII_PATTERNS]
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))
