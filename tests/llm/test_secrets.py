import hashlib
import re

from pitlane.llm.secrets import base_spans, literal_spans, mask_secrets, scan_secrets
from pitlane.llm.secrets import masked as mask


def naive(text):
    found = []
    for m in re.finditer(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return found


TEXTS = [
    None, "", "Token = \"abc\" PASSWORD:hunter2000 secret=abc apikey='AKIA" + "A" * 16 + "'",
    "é" * 5 + "api_key: deadbeef" * 4, "a" * 30, "ſecret=longenough1", "AKIAAKIA" + "B" * 20,
    "f" * 23 + " " + "0" * 24 + "g", "x" * 200_000 + " token=abcdef1",
]


def test_base_spans_match_a_plain_scan(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, TEXTS[2], "x"), (2, TEXTS[2], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = scan_secrets(df).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for i, text in enumerate(TEXTS):
        want = sorted(naive(text or ""))
        names = ("assign", "access", "hex")
        text_form = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in want)
        row = by_id[i]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        assert row.base_sha256 == hashlib.sha256(text_form.encode()).hexdigest()


def found(text):
    return [text[s:e] for _, s, e in literal_spans(text)]


def test_lexer_reports_literals_of_sensitive_names():
    assert found('client_secret = "k9Qz81LmX0aa"') == ["k9Qz81LmX0aa"]
    assert found("aws:\n  access_key: Zx81kQp07LmN42\n") == ["Zx81kQp07LmN42"]
    assert found('{"authToken": "a1B2c3D4e5F6"}') == ["a1B2c3D4e5F6"]


def test_constants_reach_their_target():
    code = 'part = "a8f7K2"\nrest = part + "Zq91xx"\ndb_password = rest\ncolour = "blue12345678"\n'
    assert found(code) == ["a8f7K2", "Zq91xx"]


def test_aligned_names():
    for blanks in (" " * 9, "\t" * 30, " " * 100_000):
        assert found(f"aws_secret_access_key{blanks}= Zx81kQp07LmN42\nregion{blanks}= eu12345-west\n") == ["Zx81kQp07LmN42"]
    assert found("p." * 200 + 'secretKey = "k9Qz81LmX0aa"') == ["k9Qz81LmX0aa"]


def test_constants_of_many_literals():
    pieces = [f"a{i}Z" for i in range(500)]
    one = "secret_value = " + " + ".join(f'"{p}"' for p in pieces)
    assert found(one) == pieces
    assert found(one.replace("secret_value", "all") + "\npassword = all\n") == pieces
    chain = 'x = "a0Z"\n' + "".join(f'x = x + "{p}"\n' for p in pieces[1:]) + "token = x\n"
    assert found(chain) == pieces
    doubled = 'x = "a8f7K2qW91"\n' + "x = x + x\n" * 500 + "token = x\n"
    assert found(doubled) == ["a8f7K2qW91"]


def test_type_annotations():
    for typed in (
        "apiKey: string", "apiKey : string", "apiKey:string", "api_key: Optional[str]", "let api_key: &'static str", "apiKey: string | null",
        "apiKey: Map<string, List<string>>", "val apiKey: String?", "api_key: std::string::String", "var apiKey string", "api_key: dict[str, str]",
    ):
        assert found(f'{typed} = "k9Qz81LmX0aa"\n') == ["k9Qz81LmX0aa"], typed
    assert found('colour: string = "blue12345678"\napiKey: string = ""\nkey, colour: string == "blue12345678"') == []
    assert found('Settings: db_password = "k9Qz81LmX0aa"') == ["k9Qz81LmX0aa"]
    assert found("secret_key: Zx81kQp07LmN42=\n") == ["Zx81kQp07LmN42="]
    assert mask("apiKey: text = 'k9Qz81LmX0aa'") == "apiKey: text = '[secret]'"


def test_harmless_values_are_left_alone():
    assert found('password = "changeme"\ntitle: The secret of the house\ntoken = None\nx == "a1b2c3d4"') == []


def test_base_is_kept_beside_literals():
    text = 'token = "0641917ea4e9feb9cda83477b57a"'
    assert {k for k, _, _ in base_spans(text)} == {"assign", "hex"}


def test_empty_table(spark):
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_masking(spark):
    rows = [(1, "x", 'password=hunter2000 and AKIA' + "B" * 16 + "."), (2, "y", None), (3, "z", "token: 0123456789abcdef0123456789")]
    df = spark.createDataFrame(rows, "doc_id long, other string, text string")
    out = {r.doc_id: r for r in mask_secrets(df).collect()}
    assert out[1].text == "password=[secret] and [secret]." and out[1].other == "x"
    assert out[2].text is None and out[3].text == "token: [secret]"
    assert mask_secrets(df).columns == df.columns


KEY = "k9Qz81LmX0aa"


def test_other_ways_to_write_a_value():
    for text, want in (
        (f'password = "{KEY[:6]}" "{KEY[6:]}"', [KEY[:6], KEY[6:]]),
        (f'password = ("{KEY[:6]}" + "{KEY[6:]}")', [KEY[:6], KEY[6:]]),
        (f'password = (\n    "{KEY[:6]}"\n    "{KEY[6:]}"\n)\n', [KEY[:6], KEY[6:]]),
        (f'password = f"{KEY}"; x = 1', [KEY]),
        (f'db_secret = rb\'{KEY}\'', [KEY]),
        (f'password = """{KEY}"""', [KEY]),
        (f'client_secret: |\n  {KEY}\nregion: eu-1\n', [KEY]),
        (f'a:\n  - client_secret: >-\n      {KEY[:6]}\n\n      {KEY[6:]}\n  - region: eu-1\n', [KEY[:6], KEY[6:]]),
        (f'client_secret = decode("{KEY}")', [KEY]),
        (f'client_secret = os.getenv("DB_PASSWORD", "{KEY}")', [KEY]),
        (f'<dbPassword type="x"> {KEY} </dbPassword>', [KEY]),
        (f'<entry key="client_secret">{KEY}</entry>', [KEY]),
        (f'<add value="{KEY}" key="clientSecret"/>', [KEY]),
        (f'client_secret: user:{KEY}', [KEY]), (f'auth:client_secret:{KEY}', [KEY]),
        (f'https://x.y/?a=1&client_secret={KEY}&b=2', [KEY]), (f'client_secret = https://x.y/{KEY}', [f"https://x.y/{KEY}"]),
    ):
        assert found(text) == want, text


def test_what_stays_no_secret():
    for text in ('colour = paint("blue12345678")', "<title>k9Qz81LmX0aa</title>", "password: |\nnext: a1b2c3d4e5\n", 'a:b:k9Qz81LmX0aa', 'secret_name = call("no digits")'):
        assert found(text) == [], text


def test_long_texts_take_linear_time():
    import time

    for piece in ("k1=v1&", "a=", "a:", "a: ", 'a="b"+', "a=(", "a=f(", "a: b|", "a=b ", "a:b<", 'a="""', "<a b=c>d</", "token=", "x: |\n ", "secret:a"):
        text = piece * (1_000_000 // len(piece))
        began = time.perf_counter()
        literal_spans(text)
        assert time.perf_counter() - began < 8, piece  # measured below 2 s alone


def plain_lexer(text):
    """Literals of one assignment a line, read character by character."""
    from pitlane.llm.secrets import SCORE, literal_score, name_score

    out, at = [], 0
    for line in text.split("\n"):
        name, _, value = line.partition(" = ")
        parts = []
        for part in value.split(" + "):
            place = at + line.index(part, len(name) + 3) if part else at
            parts.append((part[1:-1], place + 1) if part[:1] in "\"'" else (part, place))
        if name_score(name) and name_score(name) + literal_score("".join(p for p, _ in parts)) >= SCORE:
            out += [("literal", s, s + len(p)) for p, s in parts]
        at += len(line) + 1
    return sorted(out)


def test_equal_to_a_plain_lexer():
    import random

    draw = random.Random(1)
    letters = "abcXYZ0189"
    for _ in range(200):
        lines = []
        for i in range(draw.randint(1, 12)):
            name = draw.choice(["db_password", "colour", "clientSecret", "size", "api.key", "token"])
            parts = [f'"{"".join(draw.choices(letters, k=draw.randint(1, 14)))}{i}"' for _ in range(draw.randint(1, 3))]
            lines.append(f"{name} = " + " + ".join(dict.fromkeys(parts)))
        text = "\n".join(lines)
        assert literal_spans(text) == plain_lexer(text), text
