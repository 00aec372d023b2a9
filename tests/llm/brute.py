"""Plain versions of the contracts, for comparison."""

from __future__ import annotations

import hashlib
import hmac
import math
import re

import regex

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def decontaminated(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row."""
    windows = [(str(i), w[j : j + k]) for i, t in items if (w := ITEM_WORD.findall((t or "").translate(LOWER))) for j in range(max(1, len(w) - k + 1))]
    out = []
    for doc_id, text in docs:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        at: dict[str, list[int]] = {}
        for i, x in enumerate(w):
            at.setdefault(x, []).append(i)
        for name, win in windows:
            for i in at.get(win[0], []):
                if w[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    names.add(name)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(names)))
    return out


def measured(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = SPACE_WORD.findall(text)
    lines, dup = set(), 0
    for x in text.split("\n"):
        if SPACE_WORD.search(x):
            dup += x in lines
            lines.add(x)
    at: dict[tuple, list[int]] = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    hit = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def jaccard_classes(docs: list[tuple], k: int = 5, percent: int = 80) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row, from all pairs."""
    sets = []
    for _, text in docs:
        w = SPACE_WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(docs)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * (n := len(a & b)) >= percent * (len(a) + len(b) - n):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(docs):
        r = root(i)
        least[r] = min(least.get(r, doc_id), doc_id)
    return [(docs[i][0], len(sets[i]), least[root(i)]) for i in range(len(docs))]


def shares(sizes: dict, weight: dict, budget: float = 1.5, most: float = 2.0) -> dict:
    """Targets by weight; what passes a cap is shared again by the rest, until nothing does."""
    left, open_, out = budget * sum(sizes.values()), set(sizes), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "áéíóúàèìòùâêîôûäöü")


def feistel(row: list[tuple[int, int]], key: str, kind: str) -> list[int]:
    """Four rounds over the halves of (v, m): each adds to one half what the hash of the other one says."""
    h = -(-len(row) // 2)
    parts = [row[:h], row[h:]]
    for number in range(4):
        target, source = parts if number % 2 == 0 else parts[::-1]
        seed = hashlib.sha256("|".join([key, kind, str(number), str(len(row)), ",".join(str(v) for v, _ in source)]).encode()).hexdigest()
        stream = "".join(hashlib.sha256((seed + str(b)).encode()).hexdigest() for b in range(max(0, len(target) - 1) // 16 + 1))
        parts[number % 2] = [((v + int(stream[4 * i : 4 * i + 4], 16)) % m, m) for i, (v, m) in enumerate(target)]
    return [v for v, _ in parts[0] + parts[1]]


def veiled(s: str, key: str, kind: str, alphabets=ALPHABETS) -> str:
    of = [next(((a, a.index(c)) for a in alphabets if c in a), (None, 0)) for c in (x.lower() for x in s)]
    new = feistel([(v, len(a) if a else 1) for a, v in of], key, kind)
    return "".join(c if a is None else a[v].upper() if c != c.lower() else a[v] for c, (a, _), v in zip(s, of, new, strict=True))


def bare(s: str) -> str:
    return "".join(c for c in s if c.isalnum())


def refilled(s: str, new: str) -> str:
    it = iter(new)
    return "".join(next(it) if c.isalnum() else c for c in s)


def check_digit(digits: str) -> int:
    total = sum(int(x) if k % 2 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(digits)))
    return -total % 10


def mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def address(s: str, key: str) -> str:
    o = [int(x) for x in s.split(".")]
    special = {192: range(168, 169), 172: range(16, 32), 169: range(254, 255), 100: range(64, 128)}
    public = [x for x in range(1, 224) if x not in (10, 127, *special)]
    inside = special.get(o[0], range(0))
    seconds = list(inside) if o[1] in inside else [x for x in range(256) if x not in inside]
    firsts = public if o[0] in public else [o[0]]
    new = feistel([(firsts.index(o[0]), len(firsts)), (seconds.index(o[1]), len(seconds)), (o[2], 256), (o[3], 256)], key, "ip")
    return ".".join(map(str, (firsts[new[0]], seconds[new[1]], *new[2:])))


def surrogate(s: str, kind: str, key: str, titles: dict, lists: list[tuple[str, tuple]]) -> str:
    if kind == "key":
        return s[:4] + veiled(s[4:], key, "key")
    if kind == "secret":
        front = regex.match(r"[A-Za-z_-]+[ \t]{0,3}[=:][ \t]{0,3}[\"']?", s)[0]
        rest = s[len(front) :]
        return front + (veiled(rest, key, "hex", ("0123456789abcdef",)) if regex.fullmatch("[0-9a-f]+", rest) else veiled(rest, key, "secret"))
    if kind == "email":
        local, domain = s.split("@")
        host, top = domain.rsplit(".", 1)
        return veiled(local, key, "email") + "@" + veiled(host, key, "domain") + "." + top
    if kind == "ip":
        return address(s, key)
    if kind == "phone":
        front = regex.match(r"\+[0-9]{1,3}(?=[ .(-])[ .-]?\(?[0-9]|\+?\(?[0-9]", s)[0]
        return front + refilled(s[len(front) :], veiled(bare(s[len(front) :]), key, "phone"))
    if kind == "iban":
        b = bare(s)
        account = veiled(b[4:], key, "iban")
        return refilled(s, f"{b[:2]}{98 - mod97(account + b[:2] + '00'):02d}{account}")
    if kind == "card":
        b = bare(s)
        head = b[0] + veiled(b[1:-1], key, "card")
        return refilled(s, head + str(check_digit(head)))
    if kind == "ssn":
        return veiled(s, key, "ssn")
    title = max((t for g in titles.values() for t in g if regex.match(regex.escape(t) + r"\.? ", s)), key=len)
    lead = regex.match(regex.escape(title) + r"\.? ", s)[0]
    sex, out = next(g for g in titles if title in titles[g]), []
    for i, part in enumerate(regex.findall(r"[^ -]+[ -]?", s[len(lead) :])):
        name = part.rstrip(" -")
        known = next((x for g, x in lists if i == 0 and g == sex and name in x), None)
        if known:
            order = sorted(known, key=lambda x: hmac.new(key.encode(), x.encode(), hashlib.sha256).digest())
            out.append(order[(order.index(name) + 1) % len(order)] + part[len(name) :])
        else:
            out.append(veiled(part, key, "name"))
    return lead + "".join(out)


def without_pii(text: str | None, key: str, forms: dict[str, str], titles: dict, lists: list[tuple[str, tuple]]) -> tuple[str | None, list[str]]:
    """(text with surrogates, kinds): at each place the first form that matches, from left to right."""
    if text is None:
        return None, []
    at, out, kinds = 0, [], []
    each = {k: regex.compile(f) for k, f in forms.items()}
    while at < len(text):
        for kind, form in each.items():
            if m := form.match(text, at):
                s = m[0]
                # the type is that of the string alone, and numbers without a valid check stay
                kind = next(k for k, f in each.items() if f.fullmatch(s))
                b = bare(s)
                if (kind == "card" and check_digit(b[:-1]) != int(b[-1])) or (kind == "iban" and mod97(b[4:] + b[:4]) != 1):
                    out.append(s)
                else:
                    out.append(surrogate(s, kind, key, titles, lists))
                    kinds.append(kind)
                at = m.end()
                break
        else:
            out.append(text[at])
            at += 1
    return "".join(out), kinds


def pair_sum(intercept: float, w: list[float], v: list[list[float]], x: list[float]) -> float:
    """A factorisation machine's margin with every pair of features written out."""
    out = intercept + sum(a * b for a, b in zip(w, x, strict=True))
    for i in range(len(x)):
        for j in range(i):
            out += sum(a * b for a, b in zip(v[i], v[j], strict=True)) * x[i] * x[j]
    return out


def ftrl(rows: list[list[int]], y: list[int], alpha: float, beta: float, l1: float, l2: float, order: list[list[int]]) -> tuple[dict[int, float], float]:
    """FTRL-proximal one coordinate at a time: (non-zero weights, intercept); the intercept, coordinate -1, has no L1."""
    z: dict[int, float] = {}
    n: dict[int, float] = {}

    def weight(i: int) -> float:
        bound = 0.0 if i < 0 else l1
        a = z.get(i, 0.0)
        if abs(a) <= bound:
            return 0.0
        return -(a - (bound if a > 0 else -bound)) / ((beta + n.get(i, 0.0) ** 0.5) / alpha + l2)

    for epoch in order:
        for r in epoch:
            w = {i: weight(i) for i in (*rows[r], -1)}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y[r]
            for i, wi in w.items():
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * wi
                n[i] = n.get(i, 0.0) + g * g
    return {i: w for i in z if i >= 0 and (w := weight(i))}, weight(-1)


def subwords(text: str) -> list[bytes]:
    """The 3- and 4-byte windows of the lower-cased words with a blank before and after; no window has a blank inside."""
    plain = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in (text or "").encode())
    return [w for k in (3, 4) for i in range(len(plain) - k + 1) if b" " not in (w := plain[i : i + k])[1:-1]]
