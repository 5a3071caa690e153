"""Plain versions of the conversation operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_conversation(rows, key=lambda role, text: (role, text)):
    """conv_id -> [(role, text)] by turn, null first."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append(((turn is not None, turn or 0), key(role or "", text or ""), role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


def trie(rows, key):
    convs = by_conversation([r for r in rows if r[0] is not None], key)
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for n in members:
        if n:
            children[n[:-1]].add(n)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, ms in members.items():
        lost = (len(ms) - 1) * (len(n[-1][1].encode()) if n else 0)
        for d in range(len(n) + 1):
            leaves[n[:d]] += not children[n]
            saved[n[:d]] += lost
    out = []
    for n, ms in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in ms if len(built[c]) == len(n)))
        out.append((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), len(children[n]), leaves[n], saved[n], sha(ends)))
    return out


def chat(rows):
    probe = "</s>[INST] ok [/INST]"
    convs = by_conversation([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    out = []
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return out


def fill_in_middle(doc_id, text):
    t = text or ""
    units = TOKEN.findall(t)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(t), sha(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), sha(out), sha(t)
