import hashlib
import zlib

import pytest

from nightaudit.llm import prefix_trie as T


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def turns_of(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    return {c: [x[3] for x in sorted(v)] for c, v in own.items()}


def rebuilt(rows):
    own, out = turns_of(rows), {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(convs):
    members, kids = {}, {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        stack, leaves, saved = [p], 0, 0
        while stack:
            x = stack.pop()
            leaves += x not in kids
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            stack += kids.get(x, [])
        return leaves, saved

    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *below(p),
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def got(nodes):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends or T.NO_IDS)
                  for r in nodes.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", "u") for r in rows],
                                 "conv_id long, turn long, role string, text string, key string, path string, upto string")


#: Shared prefixes, equal conversations, ends inside others, a long one and its copy, one that forks deep, null values.
ROWS = ([(c, t, "user" if t % 2 == 0 else "assistant", f"é{t % 3 if t < 4 else c % 3}") for c in range(60) for t in range(c % 11)]
        + [(c, t, "user", f"long {t} {c > 71 and t > 20}") for c in (70, 71, 72) for t in range(45)]
        + [(80, None, None, None), (80, 1, "user", ""), (81, 0, "", ""), (81, 0, "", ""), (None, 0, "user", "nobody")])


@pytest.mark.parametrize("hot", [10_000, 2])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(T, "HOT_CHILDREN", hot)
    monkeypatch.setattr(T, "HOT_SHARE", 10 ** 9 if hot == 2 else 10_000)
    monkeypatch.setattr(T, "CHUNK", 8)
    df = frame(spark, ROWS)
    assert got(T.prefix_trie(df)) == brute(turns_of(ROWS))
    assert got(T.with_parents(T.peel(T.rebuilt_chains(df)))) == brute(rebuilt(ROWS))


def test_empty_and_turnless(spark):
    assert got(T.prefix_trie(frame(spark, []))) == []
    assert got(T.prefix_trie(frame(spark, [(None, 0, "user", "x")]))) == []
    rows = [(1, 0, "user", "x")]  # conversation 0 is absent; the crc32 of "1" is not 0 modulo 9
    assert zlib.crc32(b"1") % 9 > 0
    assert got(T.with_parents(T.peel(T.rebuilt_chains(frame(spark, rows))))) == [
        (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_rounds_follow_shared_depth_not_length(spark, monkeypatch):
    names = []
    real = T.stored
    monkeypatch.setattr(T, "stored", lambda df, name: names.append(name) or real(df, name))
    rows = [(c, t, "user", f"{c if t > 2 else 0} {t}") for c in range(3) for t in range(700)]
    nodes = T.peel(T.chains(frame(spark, rows)))
    assert sum(n.startswith("trie-depth") for n in names) == T.FIRST_MARK + 1
    assert nodes.count() == 4 + 3 * 697
