"""Plain Python forms of the operators' results, for comparison."""

import hashlib
import re
import zlib
from collections import Counter

BLANK = " \t\n\r\x0b\f"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().split()


def lowered(text):
    return (text or "").encode().translate(_LOWER).split()


def base_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            inside |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(inside), len(w) < 10 or 100 * len(inside) > 20 * len(w))


def remove_repeats(rows):
    """{(doc_id, text): (n_words, n_removed, sha)}; rows: distinct (doc_id, text)."""
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 19):
            place = ((i is None, i or 0), k)
            key = tuple(w[k:k + 20])
            first[key] = min(first.get(key, place), place)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 19):
            if first[tuple(w[k:k + 20])] != ((i is None, i or 0), k):
                gone |= set(range(k, k + 20))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, t] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def groups(rows):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = lowered(t)
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    up = list(range(len(sets)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= 75 * len(x | y):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(s), least.get(top(k))) for k, (i, s) in enumerate(sets)]


def contamination(rows, items):
    """[(doc_id, n_words, n_hit, item ids)]."""
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(_LOWER))
    windows = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                ids = windows.get(tuple(w[k:k + n]))
                if ids:
                    hit |= set(range(k, k + n))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
        r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def personal(text):
    text = text or ""

    def luhn(d):
        s = [int(c) for c in d[::-1]]
        return (sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0

    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# -- conversations -------------------------------------------------------------

def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, as conversations {conv_id: [(turn, role, text)]} in order."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        held = out.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        held += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(rs, key=order) for c, rs in out.items()}


def repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of one conversation in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.strip(BLANK)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    best = {"": (0, "", [])}  # what was said last -> cheapest, then least (cost, audit, messages)

    def offer(to, state, cost, audit, said):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, said)

    def with_inserts(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, audit, said) in list(states.items()):
                due = "a" if state == "u" else "u"
                offer(states, due, cost + 3, audit + "I", said + [({"u": "user", "a": "assistant"}[due], "")])
        return states

    for (_, role, text), fault in zip(rows, faults):
        to = {}
        for state, (cost, audit, said) in with_inserts(best).items():
            offer(to, state, cost + 4, audit + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            due = "a" if state == "u" else "u"
            if role[:1] == due or role[:1] == "s" and state == "":
                offer(to, role[0], cost + more, audit + "K", said + [(role, text)])
            offer(to, due, cost + 3 + more, audit + "R", said + [({"u": "user", "a": "assistant"}[due], text)])
        best = to
    ended = with_inserts(best)
    cost, audit, said = min(ended[s] for s in ("", "a") if s in ended)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())


# -- phrases --------------------------------------------------------------------

def phrases(rows, least, top, longest=5):
    """[(lang, rank, phrase, a, l, r, n, score)] of rows (lang, text)."""
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", (text or "").encode().translate(_LOWER)):
            w = [x for x in re.split(rb"[ \t]+", piece) if x]
            total[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts[lang, tuple(w[i:i + m])] += 1
    often = {k: f for k, f in counts.items() if f >= least and len(k[1]) > 1}
    out = {}
    for (lang, p), a in often.items():
        inside = lambda q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and f >= a and inside(q) for (x, q), f in often.items()):
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, b" ".join(p), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))
