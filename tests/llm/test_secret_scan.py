import hashlib
import random
import time

from rows_at_the_edge import edge_rows, narrow

from stayflow.llm import queries, secret_scan
from stayflow.llm.secret_scan import Novelty, Scanner


def spans(text, kinds=("assign", "access", "hex", "novel")):
    return [(k, text[a:b]) for k, a, b in Scanner(Novelty()).scan(text) if k in kinds]


def test_fixed_shapes():
    text = 'Password = "abcd_efg1" é token:short API-key x AKIAABCDEFGHIJKL12 AKIAshort ' + "0f" * 16 + " " + "a" * 31
    assert spans(text, ("assign", "access", "hex")) == [
        ("assign", 'Password = "abcd_efg1'),
        ("access", "AKIAABCDEFGHIJKL12"),
        ("hex", "0f" * 16),
    ]


def test_failing_match_consumes_its_text():
    assert spans("token=password=abcdefgh", ("assign",)) == [("assign", "token=password=abcdefgh")]
    assert spans("ſecret=abcdefgh toKen=abcdefgh", ("assign",)) == [("assign", "toKen=abcdefgh")]


def test_novel_strings_need_context_and_surprise():
    random_text = "dBjftJeZ4CVPmB92K27uhbUJU1p1r"
    assert spans(f"authorization header Bearer {random_text}") == [("novel", random_text)]
    assert spans(f"nothing near here {random_text}") == []
    assert spans("auth handler getConnectionStringFromEnvironment") == []
    assert spans("token type authorization_code_response_type_default") == []
    # Repeated nearby, it is no news to the compressor.
    assert spans(f"{random_text} is a name, auth by {random_text}") == []


def test_positions_are_code_points(spark):
    text = "日本😀 secret=abcdefghij"
    (row,) = secret_scan.find_secrets(narrow(spark, [(1, text)])).collect()
    (found,) = row.secrets
    assert text[found.start : found.end] == "secret=abcdefghij"


def test_edge_rows(spark):
    df = edge_rows(spark)
    rows = secret_scan.find_secrets(df).collect()
    assert len(rows) == df.count() and all(r.secrets == [] for r in rows)
    assert secret_scan.find_secrets(narrow(spark, [])).collect() == []


LETTERS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def base_by_hand(text):
    """The base spans by walking through the text, without regular expressions."""

    def run(i, allowed):
        while i < len(text) and text[i] in allowed:
            i += 1
        return i

    def assigned(i):
        low = "".join(c.lower() if c.isascii() else c for c in text[i : i + 8])
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low.startswith(word):
                j = i + len(word)
                j += text[j : j + 1] in ("'", '"')
                j = run(j, " ")
                if text[j : j + 1] in (":", "="):
                    j = run(j + 1, " ")
                    j += text[j : j + 1] in ("'", '"')
                    end = run(j, LETTERS)
                    if end > j:
                        return end, end - j
        return None

    found, i = [], 0
    while i < len(text):
        hit = assigned(i)
        if hit and hit[1] >= 8:
            found.append((i, 0, hit[0]))
        i = hit[0] if hit else i + 1
    for kind, head, allowed, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        i = 0
        while i < len(text):
            end = run(i + len(head), allowed) if text.startswith(head, i) else i
            if end > i + len(head):
                found += [(i, kind, end)] if end - i >= least else []
                i = end
            else:
                i += 1
    return sorted(found)


def test_base_spans_equal_walking_by_hand():
    rng = random.Random(4)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "api-key", ":", "=", " ", "  ", "'", '"', "é", "\n",
             "AKIA", "AKIAABCDEFGHIJKL", "0123456789abcdef", "ab_C.9", "x", "deadbeef" * 4, "日"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert Scanner(Novelty()).base(text, text.lower()) == base_by_hand(text), text


def test_words_on_either_side_count():
    random_text = "dBjftJeZ4CVPmB92K27uhbUJU1p1r"
    assert spans(f'"{random_text}" is the credential') == [("novel", random_text)]
    far = "and so on " * 60
    assert spans(f"auth {far} {random_text} {far} token") == []
    assert spans(f"auth {far[:300]} {random_text}") == [("novel", random_text)]


def test_time_grows_with_the_length():
    """Quadratic work would take hours here."""
    start = time.perf_counter()
    assert Scanner(Novelty()).scan("token is on the " * 650_000) == []  # 10 MB
    many = "token Zq8Kx2Lw9Pv4Tn7R " * 5_000
    assert len(Scanner(Novelty()).scan(many)) < 100  # it repeats itself
    assert time.perf_counter() - start < 60


def test_query_on_own_rows(spark, tmp_path):
    texts = ["secret: 'abcdefgh' AKIAABCDEFGHIJKLMN " + "0a" * 20, None, "", "nothing", "token=short"]
    narrow(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.QUERIES["op8_secret_scan"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        base = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base_by_hand(text or "")]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert rows[i].n_assign + rows[i].n_access + rows[i].n_hex == len(base)
        assert set(base) <= {*rows[i].spans.split(",")}
