import hashlib
import random
import re

from muster.llm.credentials import Automaton, Formats, base_spans, find_secrets, fit_formats, symbols


def plain_spans(text):
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([letters("password"), letters("passwd"), letters("secret"), letters("token"), f"{letters('api')}_?{letters('key')}"])
    assign = re.compile(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = [(m.start(), m.end(), 0) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, e, ("assign", "access", "hex")[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def texts(count=300):
    draw = random.Random(5)
    bits = ["password", "PASSwd", "secret", "token", "api_key", "ApiKey", "paſſword", "toKen", "=", ":", " ", '"', "'", "abc", "12345678", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "é", ".", "\n", "😀", "short", "=="]
    return ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(count)]


def test_fixed_patterns():
    for text in texts():
        assert [s[:3] for s in base_spans(text)] == plain_spans(text), text


def test_spans_and_digest(spark):
    rows = [(i, t, "x") for i, t in enumerate([*texts(60), None, "", "password=abcdef " * 3000])] + [(None, "token: abcdefg", "x"), (0, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = find_secrets(docs, fit_formats(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t, _ in rows if i == r.doc_id and (i != 0 or len(r.spans) or t == "again" or not plain_spans(t or "")))
        want = plain_spans(text or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for *_, k in want) for x in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in want).encode()).hexdigest()
        assert [f"{f.kind}:{f.start}:{f.end}" for f in r.found] == [x for x in r.spans.split(",") if x]
        assert all(f.secret == text[f.start:f.end] for f in r.found)


def made(draw, alphabet, count):
    return "".join(draw.choice(alphabet) for _ in range(count))


LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
SHAPES = {
    "ghp": lambda d: "ghp_" + made(d, LOWER + LOWER.upper() + DIGITS, 36),
    "live": lambda d: "sk_live_" + made(d, LOWER + LOWER.upper() + DIGITS, 24),
    "hex": lambda d: made(d, "abcdef" + DIGITS, d.choice([32, 40])),
    "capital hex": lambda d: made(d, "ABCDEF" + DIGITS, 40),
    "groups": lambda d: "-".join(made(d, LOWER.upper() + DIGITS, 5) for _ in range(5)),
}
ORDINARY = {
    "card": lambda d: made(d, DIGITS, 16),
    "address": lambda d: ".".join(str(d.randint(10, 255)) for _ in range(4)),
    "date": lambda d: f"{d.randint(1990, 2030)}-{d.randint(10, 12)}-{d.randint(10, 28)}",
    "slug": lambda d: "-".join(made(d, LOWER, d.randint(3, 8)) for _ in range(4)) + f"-{d.randint(1, 99)}",
    "path": lambda d: "/" + "/".join(made(d, LOWER, d.randint(3, 8)) for _ in range(3)) + f"/{d.randint(1, 999)}.html",
    "name": lambda d: made(d, LOWER, 9) + "_" + made(d, LOWER, 6),
}


def test_formats_find_unlabelled_credentials(spark):
    draw = random.Random(1)
    # Half of the credentials are labelled by an assignment; the others stand alone, and so do ordinary tokens.
    rows, wanted, plain = [], {}, {}
    for n in range(150):
        for name, make in SHAPES.items():
            rows.append((len(rows), f"see token = {make(draw)} in the settings of it", "x"))
            if name != "hex":
                token = make(draw)
                wanted[len(rows)] = (name, token)
                rows.append((len(rows), f"they sent ({token}), and no word of it", "x"))
        for name, make in ORDINARY.items():
            plain[len(rows)] = name
            rows.append((len(rows), f"read {make(draw)} again, said something", "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(5)
    found = {r.doc_id: r for r in find_secrets(docs, fit_formats(docs)).collect()}
    hit = {name: [] for name in SHAPES if name != "hex"}
    for i, (name, token) in wanted.items():
        hit[name].append(any(f.secret == token and f.kind == "format" and f.score > 0 for f in found[i].found))
    assert all(sum(h) >= 0.85 * len(h) for h in hit.values()), {k: sum(h) / len(h) for k, h in hit.items()}
    assert sum(map(sum, hit.values())) >= 0.9 * len(wanted)
    alarms = [plain[i] for i in plain if found[i].spans]
    assert len(alarms) <= 0.02 * len(plain), alarms


def test_few_credentials_make_a_format():
    draw = random.Random(2)
    words = {"numbers": [ORDINARY["card"](draw) for _ in range(50)], "words": [made(draw, LOWER, 9) for _ in range(50)]}
    formats = Formats({"assign": [SHAPES["hex"](draw) for _ in range(8)]}, words)
    assert sum(formats.judge(SHAPES["hex"](draw)) is not None for _ in range(50)) >= 25
    assert formats.judge(ORDINARY["card"](draw)) is None and formats.judge(made(draw, LOWER, 9)) is None
    assert Formats({"assign": ["changeme", "letmein12"[:7]]}, words).formats == [] and Formats({}, {}).judge("a1" * 20) is None


def test_states_merge_to_a_loop():
    automaton = Automaton(["a" * n for n in range(1, 60) for _ in range(int(400 * 0.8 ** n) + 1)]).merge()
    reached, waiting = set(), [0]
    while waiting:
        state = waiting.pop()
        if state not in reached:
            reached.add(state)
            waiting += [to for to, _ in automaton.moves[state].values()]
    assert len(reached) <= 4
    assert automaton.score("aaaa") > automaton.score("ab")
    assert symbols("aF9z_") == "hudl_" and symbols("F9Z") == "hdl"


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert find_secrets(empty, fit_formats(empty)).collect() == []
