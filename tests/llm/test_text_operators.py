"""Secret scan, SentencePiece and token files against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bankmart.llm import secret_scan as S
from bankmart.llm import sentencepiece_codec as C
from bankmart.llm import token_files as K

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
EDGES = ["", None, "a", " ", "  x  y ", "\n\t€\U0001d11e\x00", "naïve é  è", "a" * 700, " \n ", "end ", " start",
         "<s> <0x0A>", "a\n  b", "a   b", "x <|endoftext|> y", "a  \n", "don't it's  'll", "a b c", "a 　 b",
         "ab\r\n c", "漢字 かな 漢 字", "Привет мир  и", "x " * 300, "👍🏽 ok 👍", "a b   c"]


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns(texts):
    rng = random.Random(2)
    pieces = ["password", "token=", "API_KEY: '", "AKIA", "ABCDEF0123456789", "0123456789abcdef", " ", "=", "\"", "x",
              "ſecret=abcdef", "toKen:abcdefg", "é", "\n"]
    made = ["".join(rng.choices(pieces, k=rng.randrange(1, 14))) for _ in range(3000)]
    for text in [*texts.values(), *made]:
        assert [s[:3] for s in S.scan(text) if s[1] < 3] == base(text)


def test_assignments_and_constants():
    code = '''
PART = "s3cr3tPart9x"
joined = PART + "Zz81-qwe"
db_password = joined
client.auth: {"private_key": "MIIEvQIBADANBg", "name": "bob-1234X"}
export SIGNING_KEY=aB9+xk/2LLq0
password_length = "Xx12345678"
if passphrase == "Abc123def!": pass
home = "https://x.example/Ab12345"
token_url = "Qw12345678"
'''
    found = {code[a:z] for a, z in S.lexed_spans(code)}
    assert found == {"s3cr3tPart9x", "Zz81-qwe", "MIIEvQIBADANBg", "aB9+xk/2LLq0"}
    clean = S.redact(code, S.scan(code))
    assert not any(x in clean for x in found) and "bob-1234X" in clean
    assert S.lexed_spans("a=" * 50_000) == [] and S.lexed_spans("x = '" * 20_000) == []


def found_in(code):
    return {code[a:z] for a, z in S.lexed_spans(code)}


def test_long_literals_key_blocks_and_phrases():
    rng = random.Random(4)
    random_text = lambda n: "".join(rng.choices("ABCDEFGHabcdefgh0123456789+/", k=n))
    lines = "\\n".join(random_text(64) for _ in range(26))
    block = f"-----BEGIN PRIVATE KEY-----\\n{lines}\\n-----END PRIVATE KEY-----\\n"
    assert found_in('{"private_key": "%s", "client": "bob"}' % block) == {block}
    plain = "-----BEGIN RSA PRIVATE KEY-----\n  MIIE%s\n  -----END RSA PRIVATE KEY-----" % random_text(60)
    assert found_in(f"private_key: |\n  {plain}\nname: x1") == {plain}
    for n in (513, 1600, 5000, 70_000):
        long = random_text(n)
        assert found_in(f'signing_key = "{long}"') == {long} == found_in(f"SIGNING_KEY={long}\nA=b")
        assert found_in(f'auth_key = """{long}"""') == {long}
    assert found_in(f"bearer: 'Bearer {random_text(900)}'")
    assert found_in('passphrase = "correct horse battery staple"') == {"correct horse battery staple"}
    assert not found_in('password: "Please enter a value"\npassword = "The password is too short"\ntitle = "correct horse"')


def test_constants_of_many_pieces():
    pieces = [f"Pq{i:03d}xZ7-" for i in range(200)]
    code = "\n".join(f'k{i} = {f"k{i - 1} + " if i else ""}"{p}"' for i, p in enumerate(pieces))
    assert found_in(code + "\nclient_secret = k199") == set(pieces)
    assert found_in("secret_key = " + " + ".join(f'"{p}"' for p in pieces)) == set(pieces)
    assert found_in('a = b + "Pq1-xZ7"\nb = a + "Rs2-yW8"\npwd = b') == {"Pq1-xZ7", "Rs2-yW8"}
    assert "Pq1-xZ7" in found_in('k = "Pq1-xZ7"\nURL_TOKEN=' + "ab1/" * 400 + "${k}/x")
    chain = "p0_secret = \"Ab1-Cd2-Ef\"\n" + "\n".join(f"p{i}_secret = p{i - 1}_secret" for i in range(1, 20_000))
    assert found_in(chain) == {"Ab1-Cd2-Ef"} and len(found_in("token=" * 5_000)) <= 5_000


@pytest.mark.parametrize("code", [
    'const signingKey: string = "{}";', "let clientPwd: string | null = '{}';", "private pwd?: string = `{}`;",
    'client_pwd: str = "{}"', 'pwd: Optional[str] = "{}"', 'client_pwd: str | None = "{}"', 'pwd: Final = "{}"',
    'client_pwd: bytes = b"{}"', 'client_pwd:str="{}"', 'def f(a, pwd: str = "{}", b=1): pass',
    'val clientPwd: String? = "{}"', 'const SIGNING_KEY: &str = "{}";', "static PWD: &'static str = \"{}\";",
    'const PWD: &[u8] = b"{}";', 'let pwd: String = "{}"', 'var pwd string = "{}"', 'const signingKey string = "{}"',
    'var (\n\tpwd string = "{}"\n)', 'var pwd creds.Value = "{}"', 'pwd := "{}"', 'String pwd = "{}";',
    'const string ApiKey = "{}";', 'Dim pwd As String = "{}"', "DECLARE @pwd NVARCHAR(50) = '{}'",
    'key: str = "{}"\nclient_pwd: str = key', 'password: SecretStr = "{}"'])
def test_typed_assignments(code):
    value = "Zx9-kQ2_vB7n"
    assert found_in(code.replace("{}", value)) == {value}


def test_types_are_not_names_of_constants():
    for code in ('label: string = "Zx9-kQ2_vB7n"\npassword: string', 'if password: label = "Zx9-kQ2_vB7n"'):
        assert found_in(code) == set()
    assert found_in("secret: QUJDREVGx1=\nenv: PASSWORD=aB3dE5fG7") >= {"QUJDREVGx1=", "aB3dE5fG7"}


def test_secret_rows(odd, none):
    rows = S.scan_secrets(odd).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert len(rows) == odd.count() and all(r.base_sha256 == nothing for r in rows if r.n_hex + r.n_assign + r.n_access == 0)
    assert S.scan_secrets(none).count() == 0
    clean = S.redact_secrets(odd.withColumn("text", F.concat("text", F.lit(" token=abcdef123"))))
    assert clean.columns == odd.columns
    got = {(r.doc_id, r.text is None or (r.text.endswith("token=[SECRET]") and r.n_chars == len(r.text)))
           for r in clean.collect()}
    assert all(ok for _, ok in got)


@pytest.fixture(scope="module")
def model():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_pieces_are_the_librarys(texts, model):
    codec, plain = C.Codec(C.load_pieces(model)), sentencepiece.SentencePieceProcessor(model_file=model)
    sample = [*EDGES, *texts.values()]
    ids, ends = codec.encode(pa.array(sample, pa.string()))
    decoded = codec.decode(ids, ends)
    for t, a, z, back in zip(sample, ends[:-1], ends[1:], decoded):
        assert ids[a:z].tolist() == plain.encode(t or "")
        assert back.decode() == (t or "")


def test_unigram_viterbi_is_optimal(texts, model):
    pieces = C.load_pieces(model, "unigram")
    codec = C.Codec(pieces)
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    score = {plain.id_to_piece(int(i)): (s, int(i)) for i, s in zip(pieces.ids, pieces.scores)}

    def brute(text):
        text = C.SPACE + text.replace(" ", C.SPACE)
        best = [(0.0, [])]
        for end in range(1, len(text) + 1):
            found = None
            for size in range(min(end, pieces.longest), 0, -1):
                piece = text[end - size:end]
                if piece in score:
                    s, ids = score[piece][0], [score[piece][1]]
                elif size == 1:
                    s, ids = pieces.unknown, [int(pieces.byte_ids[b]) for b in piece.encode()]
                else:
                    continue
                if found is None or best[end - size][0] + s > found[0]:
                    found = (best[end - size][0] + s, best[end - size][1] + ids)
            best.append(found)
        return best[-1][1]

    for text in [*filter(None, EDGES), *list(texts.values())[:3]]:
        assert codec.encode(pa.array([text]))[0].tolist() == brute(text)


def test_piece_rows(odd, none, model):
    rows = C.encode_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(r.round_trip for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (3, 4)} == {0}
    back = {(r.doc_id, r.text) for r in C.decode_documents(C.encode_documents(odd, model), model).collect()}
    assert back == {(r.doc_id, r.text or "") for r in odd.collect()}
    assert C.encode_documents(none, model).count() == 0


@pytest.fixture(scope="module")
def bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_parts_encode_as_whole_texts(texts, bpe):
    encoder, plain = K.Encoder(bpe, 2), Tokenizer.from_file(bpe)
    sample = [*EDGES, *texts.values()]
    ids, ends = encoder.encode(pa.array(sample, pa.string()))
    for t, a, z in zip(sample, ends[:-1], ends[1:]):
        assert ids[a:z].tolist() == [*plain.encode(t or "", add_special_tokens=False).ids, 2]
    assert len(K.Encoder(bpe, None).encode(pa.array([None, ""], pa.string()))[0]) == 0


def test_distinct_parts_are_encoded_once(bpe):
    """Half a million distinct words fit into what a task remembers; none goes through the tokenizer twice."""
    encoder, plain = K.Encoder(bpe, 2), Tokenizer.from_file(bpe)
    seen, own = [], encoder._encoded
    encoder._encoded = lambda texts: (seen.append(sum(map(len, texts))), own(texts))[1]
    texts = [" ".join(f"x{i * 560 + j}y" for j in range(560)) for i in range(1000)]
    first = [encoder.encode(pa.array(texts[a:a + 250])) for a in range(0, 1000, 250)]
    sent = sum(seen)
    again = [encoder.encode(pa.array(texts[a:a + 250])) for a in range(0, 1000, 250)]
    assert sum(seen) == sent <= sum(map(len, texts))
    for (ids, ends), (same, at) in zip(first, again):
        assert ids.tolist() == same.tolist() and ends.tolist() == at.tolist()
    ids, ends = first[2]
    assert ids[ends[7]:ends[8]].tolist() == [*plain.encode(texts[507], add_special_tokens=False).ids, 2]


def test_part_table_is_bounded_by_bytes(monkeypatch):
    def encode(parts):
        parts = parts.to_pylist()
        return np.concatenate([np.arange(len(p)) for p in parts]), np.array([len(p) for p in parts])

    table = K.PartTable(encode)
    monkeypatch.setattr(K.PartTable, "BYTES", 50_000)
    for i in range(100):
        parts = [f"{i // 2}-{j}-" + "x" * 200 for j in range(i % 2, 20 + i % 2)]
        flat, begin, size = table.of(pa.array(parts, pa.large_string()))
        assert [flat[a:a + n].tolist() for a, n in zip(begin, size)] == [list(range(len(p))) for p in parts]
        assert table.held <= 50_000 and len(table.known) <= 60
    empty = K.PartTable(encode).of(pa.array([], pa.large_string()))
    assert [len(x) for x in empty] == [0, 0, 0]


def test_files_round_trip(spark, sf, texts, bpe):
    plain = Tokenizer.from_file(bpe)
    documents = spark.read.parquet(f"{sf}/documents.parquet").repartition(5)
    manifest = K.write_token_files(documents, bpe)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in K.read_token_files(manifest).collect()}
    at, want = 0, {}
    for i in sorted(texts):
        ids = [*plain.encode(texts[i], add_special_tokens=False).ids, 2]
        want[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want
    # one document, and a file whose content was changed
    row = manifest.orderBy("partition").first()
    assert K.document_ids(row.folder, row.file, 0)[0].tolist() == [*plain.encode(texts[0], add_special_tokens=False).ids, 2]
    store, path = K.open_store(row.folder)
    with store.open_input_file(f"{path}/{row.file}") as f:
        reader, data = K.FileReader(f), bytearray(f.read_at(f.size(), 0))
    data[int(reader.ends[0]) + 20] ^= 255
    changed = f"{path}/changed.zst"
    with store.open_output_stream(changed, compression=None) as f:
        f.write(bytes(data))
    with store.open_input_file(changed) as f, pytest.raises(Exception):
        K.FileReader(f).ids(0)


def test_file_rows(odd, none, bpe):
    rows = K.read_token_files(K.write_token_files(odd, bpe)).collect()
    assert len(rows) == odd.count()
    rows.sort(key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {1}
    assert K.read_token_files(K.write_token_files(none, bpe)).count() == 0


def test_long_parts_equal_the_library():
    """Scripts without spaces, encoded data, runs and words of 32,000 characters; windows that have to move."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, codec = sentencepiece.SentencePieceProcessor(model_file=path), C.Codec(C.load_pieces(path))
    rng = random.Random(8)
    pieces = [p for p in (library.id_to_piece(i).replace("▁", "") for i in range(300, library.get_piece_size())) if p]
    chinese = [chr(c) for c in range(0x4E00, 0x9F00)]
    made = ["".join(rng.choices(chinese, k=30_000)), "".join(rng.choices(pieces, k=9_000)),
            "".join(rng.choices([p for p in pieces if any(c > "⺀" for c in p)], k=5_000)),
            "".join(rng.choices("ABCDEFabcdef0123456789+/", k=32_000)), "a" * 32_000, "=" * 32_001, "ab" * 5_000,
            "".join(rng.choice("-=*") * rng.randrange(1, 400) for _ in range(60)), "internationalisation" * 1_600,
            *("".join(rng.choices(pieces, k=60)) for _ in range(300)),
            *("".join(rng.choices("aA=", k=n)) for n in range(180, 460, 3))]
    ids, ends = codec.encode(pa.array(made))
    for i, text in enumerate(made):
        assert ids[ends[i]:ends[i + 1]].tolist() == library.encode(text)
    assert codec.decode(ids, ends) == [t.encode() for t in made]
    assert len(C.segment_windows(np.frombuffer(("▁" + "=" * 900).encode("utf-32-le"), np.uint32), np.array([0]),
                                 np.array([901]), codec.pieces)) == 1      # after moving to the run's borders


def test_unigram_parts_of_any_length_have_the_best_score():
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = C.load_pieces(path, "unigram")
    codec, rng = C.Codec(pieces), random.Random(9)
    for text in ["".join(rng.choices("theinrsat", k=n)) for n in (1, 2, 7, 40, 300)]:
        ids, _ = codec.encode(pa.array([text]))
        own = dict(zip(pieces.ids.tolist(), pieces.scores.tolist()))
        names = {b.decode(): i for i, b in enumerate(pieces.bytes_of) if i in own}
        whole = " " + text
        best = [0.0] + [-1e18] * len(whole)
        for end in range(1, len(whole) + 1):
            for a in range(max(0, end - pieces.longest), end):
                if whole[a:end] in names:
                    best[end] = max(best[end], best[a] + own[names[whole[a:end]]])
        assert abs(sum(own[i] for i in ids.tolist()) - best[-1]) < 1e-6


def test_part_cache_is_bounded_by_bytes(monkeypatch):
    from bankmart.llm.common import PartCache

    cache = PartCache(lambda parts: (np.concatenate([np.arange(len(p)) for p in parts]), np.array([len(p) for p in parts])))
    monkeypatch.setattr(PartCache, "BYTES", 50_000)
    for i in range(100):
        parts = [f"{i}-{j}-" + "x" * 200 for j in range(20)]
        flat, begin, size = cache.of(parts)
        assert [flat[a:a + n].tolist() for a, n in zip(begin, size)] == [list(range(len(p))) for p in parts]
        assert cache.held <= 50_000 and len(cache.number) <= 60


SECRET = "Zk29fjW2x"


@pytest.mark.parametrize("code", [
    f'pwd = ("{SECRET}")', f'pwd = [\n  "{SECRET}",\n]', f'{{"pwd": {{"value": "{SECRET}"}}}}',
    f'os.environ.setdefault("DB_PWD", "{SECRET}")', f'config.put("pwd", "{SECRET}");', f"<pwd>{SECRET}</pwd>",
    f'<db-pwd kind="x">\n {SECRET} \n</db-pwd>', f"mysql --db-pwd {SECRET} -h host", f'run --client-pwd "{SECRET}"',
    f'pwd{" " * 300}= "{SECRET}"', f'pwd: Map<String, List<{"Very" * 30}>> = "{SECRET}"',
    f'{{"{"x" * 130}_pwd": "{SECRET}"}}', f'pwd =\n    "{SECRET}"', f'pwd := "{SECRET}"', f"$pwd => '{SECRET}'",
    f'/* a comment */ pwd /* of "two" */ = /* parts */ "{SECRET}"'])
def test_literals_that_belong_by_structure(code):
    assert [code[a:z] for a, _, _, *s in [x for x in S.scan(code) if x[1] == 3] for a, z in [s]] == [SECRET]
    assert SECRET not in S.redact(code, S.scan(code))


@pytest.mark.parametrize("code", [
    f'name = ("{SECRET}" "xQ7pLm41")', 'print("your pwd", "Hello there you")', f'pwd_length = ["{SECRET}"]',
    f'f(pwd, other="{SECRET}")', "<token>the</token>", "--token the", f'log("pwd", name)\nx = "{SECRET}"',
    f'{{"pwd": {{"hint": "{SECRET}"}}}}', f"don't use the pwd, it's '{SECRET}'", "key: |\n  plain\n"])
def test_literals_of_other_names_stay(code):
    assert [x for x in S.scan(code) if x[1] == 3] == []


def test_blocks_of_lines_are_whole():
    code = f"a: 1\npwd: |\n  {SECRET} and\n\n  more lines\n    deeper\nname: x\n  - secret_key: >-\n      {SECRET}\n  other: y\n"
    clean = S.redact(code, S.scan(code))
    assert clean == "a: 1\npwd: |\n  [SECRET]\nname: x\n  - secret_key: >-\n      [SECRET]\n  other: y\n"


def test_random_nesting_against_a_plain_reading():
    """Small grammar of nested dictionaries and lists: literals under a sensitive key that only generic keys or lists follow."""
    rng = random.Random(10)

    def made(depth, owner):
        """(text, literals that belong to a sensitive name)."""
        kind = rng.randrange(3) if depth else 0
        if kind == 0:
            value = "Zk" + "".join(rng.choices("abcdXYZ0123456789", k=10)) + "9x"
            return f'"{value}"', [value] if owner else []
        if kind == 1:
            parts = [made(depth - 1, owner) for _ in range(rng.randrange(1, 4))]
            return "[" + ", ".join(p for p, _ in parts) + "]", [x for _, f in parts for x in f]
        text, found = [], []
        for _ in range(rng.randrange(1, 4)):
            name = rng.choice(["pwd", "db_pwd", "value", "data", "host", "user"])
            own = name.endswith("pwd") or (name in ("value", "data") and owner)
            p, f = made(depth - 1, own)
            text.append(f'"{name}": {p}')
            found += f
        return "{" + rng.choice([", ", ",\n  "]).join(text) + "}", found

    for _ in range(400):
        text, want = made(rng.randrange(1, 5), False)
        got = {text[a:z] for a, z in S.structured_spans(text, S.sensitivity, S.literal_score)}
        assert {x for x in got} == {x for x in want if S.literal_score(x) * 0.9 >= 0.5}, text


def test_score_is_of_the_whole_literal():
    """What tells a credential from a filler or a message may stand anywhere in a long literal."""
    rng = random.Random(12)
    inner = "".join(rng.choices("abcdefgXYZ0123456789+/", k=900))
    for text, found in [(f'pwd = "{"a" * 300}{inner}{"a" * 300}"', True), (f'pwd = "{"ab " * 200}{"ab" * 150}<b> x"', False),
                        (f'pwd = "{"one two " * 60}please {"one two " * 60}x"', False),
                        (f'db_pwd: {"a" * 300}{inner}{"a" * 300}', True),
                        (f'pwd = """{"x" * 80}\n-----BEGIN KEY-----"""', True)]:
        assert any(s[1] == 3 for s in S.scan(text)) == found, text[:40]


def test_shared_counts_give_the_score_of_each_literal():
    rng = random.Random(13)
    text = "".join(rng.choices("ab=:/@X7 \n<", weights=[9, 9, 3, 3, 3, 1, 9, 9, 1, 1, 1], k=400)) + "://" + "aX9=" * 9
    literals = S.Literals(text)
    for _ in range(2000):
        a, z = sorted((rng.randrange(len(text)), rng.choice([len(text), rng.randrange(len(text))])))
        assert literals.score(a, z) == S.literal_score(text[a:z])
    # many names in one bare run, which all end with it
    run = "token=Zk83hQ71xV&" * 20_000
    assert len(S.lexed_spans(run)) >= 20_000
