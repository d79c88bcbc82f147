"""Operators 11 to 13 against plain versions in Python."""
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tillcast.llm import audit, repair, secrets

SF = "/root/testdata/sf0.01"
SPACE = b" \t\n\v\f\r".decode()


# 11 repair

def edits_of(role, fault):
    """(cost, letter, output role or None) of a row's edits."""
    extra = 3 if fault == "truncated" else 0
    out = [(4, "D", None)]
    if fault not in ("blank", "duplicate"):
        out += [(3 + extra, "R", "user"), (3 + extra, "R", "assistant"), (extra, "K", role)]
    return out


def best_edits(rows):
    """Every edit string with up to two inserts at a place, cheapest and least first."""
    found = []
    inserts = [()] + [(a,) for a in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    options = []
    for role, text, fault in rows:
        options.append([(3 * len(i), "I" * len(i), [(x, "") for x in i]) for i in inserts])
        options.append([(c, letter, [(out, text)] if out is not None else []) for c, letter, out in edits_of(role, fault)])
    options.append([(3 * len(i), "I" * len(i), [(x, "") for x in i]) for i in inserts])
    # By prefix: only prefixes that can still be accepted are kept.
    state = [(0, "", [])]
    for option in options:
        grown = []
        for (cost, letters, out), (more, letter, add) in itertools.product(state, option):
            new = out + add
            if re.fullmatch(r"s?(ua)*u?", "".join(r[:1] if r[:1] else "?" for r, _ in new)):
                grown.append((cost + more, letters + letter, new))
        best = {}
        for item in sorted(grown, key=lambda x: x[:2]):  # the rest depends on the initials' end only
            initials = "".join(r[:1] for r, _ in item[2])
            best.setdefault((initials[-1:], len(initials) > 0), item)
        state = list(best.values())
    for cost, letters, out in state:
        if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
            found.append((cost, letters, out))
    return min(found, key=lambda x: x[:2])


def plain_repair(rows):
    """rows: (conv_id, turn, role, text)."""
    after, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        damage = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        row = (turn, "user" if damage == 4 else role, text)
        after[conv] += [row] * (0 if damage == 0 else 2 if damage == 3 else 1)
    out = {}
    for conv in ids:
        turns = sorted(after[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulty = set(), []
        for _, role, text in turns:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        numbers = {t for t, _, _ in turns if t is not None}
        count = lambda f: sum(x[2] == f for x in faulty)  # noqa: B023, E731
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(faulty))
        cost, letters, lines = best_edits(faulty)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count("blank"), count("duplicate"), count("truncated"), illegal,
                     cost, letters, digest)
    return out


def repaired(df):
    return {r[0]: tuple(r[1:]) for r in repair.repair(df).collect()}


@pytest.mark.parametrize("block", [3, 2048])
def test_repair_of_odd_conversations(spark, monkeypatch, block):
    """Random roles and texts, nulls, ties, a conversation over many blocks; small and large blocks."""
    monkeypatch.setattr(repair, "BLOCK", block)
    draw = random.Random(3)
    rows = []
    for conv in [None, *range(60), 1 << 60]:
        for turn in range(40 if conv in (None, 7) else draw.randint(1, 9)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]),
                         draw.choice(["user", "assistant", "user", "assistant", "system", "", "tool", "User", "sys", None]),
                         draw.choice(["yes.", "no", "Why? ", "   ", "", None, "so it is!\n", "é\x85", "one. two", f"text {turn}."])))
    rows += [(5, 0, "user", "again.")] * 4 + [(9, 1, "user", "x" * 200_000 + ".")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert repaired(df) == plain_repair(rows)


def test_repair_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert repaired(df) == plain_repair([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_agenda_combines_pieces():
    """Items of pieces combine to the items of the whole, whatever the cut."""
    draw = random.Random(4)
    for _ in range(60):
        codes = "".join(draw.choice("suaSUA-?!") for _ in range(draw.randint(1, 12)))
        cuts = sorted(draw.sample(range(len(codes) + 1), 2))
        pieces = [{(p, q): w for p in repair.STATES for q, w in repair.row_items(part, p, False).items()}
                  for part in (codes[:cuts[0]], codes[cuts[0]:cuts[1]], codes[cuts[1]:])]
        for p in repair.STATES:
            assert repair.joined_items(pieces, p) == repair.row_items(codes, p, False)
        ends = {q: w for q, w in repair.row_items(codes, 0, False).items() if q in repair.FINAL}
        assert list(repair.row_items(codes, 0, True).values()) == [min(ends.values())]


# 12 audit

def plain_audit(docs, labels):
    """docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and first[text] < i}
        parts[lang or ""].append(({f for f in fails if fails[f]}, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part, rows in parts.items():
        worth = defaultdict(int)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                worth[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == {f} for r in rows),
                                          sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for order, step in itertools.product(map("".join, itertools.permutations("ABCDE")), range(1, 6)):
            out[part, order, step].append(worth[order[step - 1]])
    return out


@pytest.mark.parametrize("folder", ["sf0.001", "odd"])
def test_audit(spark, request, folder):
    path = request.getfixturevalue("odd") if folder == "odd" else f"/root/testdata/{folder}"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    want = plain_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], [tuple(r)[:3] for r in labels.select("doc_id", "quality", "toxic").collect()])
    got = {tuple(r[:3]): list(r[3:]) for r in audit.filter_audit(docs, labels).collect()}
    assert got == want


# 13 secrets

def plain_secrets(docs):
    """docs: (doc_id, text, source)."""
    rows, owners = [], defaultdict(set)
    for i, text, source in docs:
        text, found = text or "", []
        letter = "".join
        name = "|".join(letter(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
        for rank, (kind, pattern, group, least) in enumerate((
                ("assign", rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
                ("token", "[A-Za-z0-9+/_=-]+", 0, 20))):
            found += [(m.start(), rank, kind, m.end(), m[group]) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        base = sorted(s for s in found if s[2] != "token")
        extra = [s for s in found if s[2] == "token" and not any(b[0] < s[3] and s[0] < b[3] for b in base)]
        rows.append((i, base, extra))
        for s in base + extra:
            owners[s[4]].add(source)

    def verdict(value):
        live = (len(value) >= 16 and re.search("[0-9]", value) and re.search("[A-Za-z]", value) and len(set(value)) >= 8
                and not re.search("example|sample|changeme|placeholder|dummy|your|xxxx|0000|1234", value, re.I))
        return "copied" if len(owners[value]) >= 3 else "owned" if live else "weak"

    out = []
    for i, base, extra in rows:
        spans = sorted(base + [s for s in extra if verdict(s[4]) == "owned"])
        said = lambda ss, more=False: ",".join(f"{k}:{a}:{b}" + (f":{verdict(v)}" if more else "") for a, _, k, b, v in ss)
        kinds = [s[2] for s in base]
        verdicts = [verdict(s[4]) for s in spans]
        out.append((i, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(said(base).encode()).hexdigest(), said(spans),
                    *map(verdicts.count, ("owned", "copied", "weak")), said(spans, True)))
    return sorted(out, key=str)


def test_secrets(spark):
    draw = random.Random(6)
    live, shared = "q7Zp-91kLm+02sVbTx8R", "Abc9Def8Ghi7Jkl6Mno5"
    rows = [(i, f"see {shared} and é日本 PassWord : '{'ab' * (i % 5)}' token=x secret=token: abcdefgh", f"s{i % 4}") for i in range(12)]
    rows += [(50, f"mine {live} here", "s1"), (50, f"mine {live} here", "s1"), (51, f"api_key={live}", "s2"), (52, f"APIKEY=\"{live}x AKIA{'Z9' * 8}{'AKIA' * 2}", None),
             (53, "AKIASHORT AKIA" + "B7" * 8, "s0"), (54, "f" * 23 + " " + "0f" * 12 + "g" + "ab12" * 6, "s0"), (None, None, None), (None, "", "s1"),
             (55, " ".join(f"token={draw.randbytes(20).hex()}" for _ in range(3000)), "s3"), (56, "passwd='' secret=  = api_key: aſecret=abcdefgh toKen:abcdef", "s1"),
             (57, "example" + "9a8b7c6d5e4f" * 2, "s1"), (58, "x" * 300_000 + live, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted((tuple(r) for r in secrets.find_secrets(df).collect()), key=str) == plain_secrets(rows)


@pytest.mark.parametrize("folder", ["sf0.01", "odd"])
def test_secrets_of_the_table(spark, request, folder):
    path = request.getfixturevalue("odd") if folder == "odd" else f"/root/testdata/{folder}"
    df = spark.read.parquet(f"{path}/documents.parquet")
    want = plain_secrets([(r.doc_id, r.text, r.source) for r in df.collect()])
    assert sorted((tuple(r) for r in secrets.find_secrets(df).collect()), key=str) == want
