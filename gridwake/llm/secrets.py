"""Secret scan: candidates, and a random forest against false positives.

Everything on the way of a text is a column expression: candidates are cut
out with one regular expression (the same one splits the text, so candidate i
stands between piece i and piece i + 1, which hold its neighbouring words),
each candidate gets features, and the forest is a sum of nested CASE
expressions over them. No shuffle, one pass.

Candidates: PEM blocks; the value after a credential word and ``:`` or ``=``,
whatever its length and characters; passwords in URLs; and runs of 16 or more
key characters with a digit.

Features: length; shares of character classes; class transitions and the
longest-run structure; distinct characters; how much of the candidate common
words cover (dictionary coverage); known key formats; what the words before
it say (credential words, checksum words, an assignment, quotes); whether it
is part of a path, address or identifier; what the document's path says; whether it is
a URL's password, a (private) PEM block, a reference or a word of prose.

The forest is trained (numpy, on the driver) from labelled findings: rows
``before, candidate, after, path, label``. ``labelled_findings`` derives a
bounded set from rules: keys and tokens in the places where leaks stand,
against checksums, identifiers, long words with digits, addresses, numbers
and placeholders. Pass reviewed findings to replace it.

Defined results: null and empty texts have no findings; repeated rows have
their findings each; a null path says nothing. Very long texts are scanned
whole, in time that grows with their length. Candidates that could begin at
the same place (a tie) are taken in the order of the rules. An empty table
gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TREES = 15
DEPTH = 6
LEAF = 5
FINDINGS = 6000           # rows of the derived training set
CUT = 0.5
MASK = "[SECRET]"

# the name of a credential up to where its value begins; bounded, for a lookbehind
ASSIGNED = (r"(?i:(?:passw(?:or)?d|passwd|passphrase|passcode|passwort|pwd|secret(?!ar)|token(?!iz)|credential|bearer"
            r"|(?:api|access|private|signing|encryption)[ _-]?key|auth(?!or(?!iz)))[\w-]{0,20}[\"'`\]]{0,2}"
            r"[ \t]{0,20}[:=]{1,2}>?[ \t]{0,20}(?:[\"'`]?(?:bearer|basic)[ \t]{1,4})?[\"'`]?)")
URL_USER = r"://[^\s/?#@:\"'<>]{0,255}:"
# Candidates, first alternative first: a PEM block (or its header and the base64 lines after it, where the end is cut
# off); the value of a named credential, whatever its length and characters, to the closing quote on its line or else
# to the next white space or URL parameter, less closing marks; the password of a URL; a run of key characters of 16
# or more with a digit in it. Groups repeat possessively: Java then loops instead of recursing over long texts.
PEM = (r"-----BEGIN [A-Z0-9 ]{1,60}-----(?:(?:(?!-----)[\s\S])*+-----END [A-Z0-9 ]{1,60}-----"
       r"|(?:\s|\\[nr])*+(?:[A-Za-z0-9+/=]{40,}+(?:\s|\\[nr])*+)++)")
VALUE = (r"(?<=[:=> \t\"'`])(?<=[:=]>?[ \t]{0,20}(?:[\"'`]?[A-Za-z]{5,6}[ \t]{1,4})?[\"'`]?)(?![\s\"'`])(?<=" + ASSIGNED
         + r")(?!(?i:bearer|basic)[ \t])(?:"
         + "|".join(rf"(?<={q})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?={q})" for q in "\"'`")
         + r"|(?:[^\s&,.;)\]}\"'`>]++|&(?!\w{1,40}=)|[,.;)\]}\"'`>]++(?!\s|$))++)")
URL_PASSWORD = rf"(?<=:)(?<={URL_USER})[^\s/?#\"'<>]+(?=@)"
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])"
CANDIDATE = f"{PEM}|{VALUE}|{URL_PASSWORD}|{RUN}"
CONTEXT = 320             # characters of a neighbouring piece that features read (the lookbehinds reach no further)

# fixed values: words around and formats of credentials
CREDENTIAL_WORD = (r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth\w*"
                   r"|bearer|credential\w*|client[ _-]?secret)[\"' ]{0,3}[:=]{0,2}>?[\"' ]{0,3}$")
BENIGN_WORD = (r"(?i)(sha-?\d*|md5|checksum|digest|hash|commit|revision|rev|etag|uuid|guid|build|version|id|ref|isbn|doi"
               r"|phone|tel|card|order|invoice|serial)[\"' ]{0,3}[:=#]{0,2}[\"' ]{0,3}$")
KEY_FORMAT = (r"^(A(KIA|SIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{30,}|sk_(live|test)_[0-9A-Za-z]{16,}"
              r"|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{16,}|glpat-[0-9A-Za-z_-]{20,})$")
DICTIONARY = (r"(example|sample|dummy|changeme|placeholder|password|secret|token|test|your|this|that|with|from|tion|ment|"
              r"ing|the|and|for|key|user|name|file|data|index|page|image|http|www|com|org|net|xxxx|0000|1234|abcd)")
# values that stand for a credential kept elsewhere, its type or a mask
REFERENCE = (r"(?i)^([$%{<\[].*|\*+|x+|\.+|-+|(os|process|env|config|settings|self|this|args|request|options)\b[.\[].*"
             r"|\w*(getenv|environ|input|prompt)\w*[(\[].*|null|nil|none|true|false|undefined|str(ing)?|int|bytes|bool(ean)?"
             r"|optional|required|redacted|masked|hidden|default|empty|unset)$")
PROSE = (r"(?i)^(the|a|an|is|are|was|must|may|can|will|to|and|or|of|in|on|for|not|never|always|enter|see|click|forgot(ten)?"
         r"|reset|change|please|your|my|our|this|that|it|use|used|at|least|wrong|invalid|incorrect|missing|expired)$")
TEST_PATH = r"(?i)(^|[/_.-])(test|tests|spec|example|examples|sample|fixture|fixtures|docs?|mock)([/_.-]|$)"


def candidates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def pieces(text: Column) -> Column:
    """The text around the candidates: one more piece than candidates."""
    return F.split(text, CANDIDATE, -1)


def feature_columns(before: Column, c: Column, after: Column, path: Column) -> list[tuple[str, Column]]:
    before = F.right(before, F.lit(CONTEXT))
    after = F.left(after, F.lit(CONTEXT))
    n = F.length(c).cast("double")
    classes = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"),
                                           "[0-9]", "0"), "+/_-=", "#####")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / n

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")
    return [
        ("length", n),
        ("digits", share("[0-9]")),
        ("lower", share("[a-z]")),
        ("upper", share("[A-Z]")),
        ("marks", share("[+/_=-]")),
        ("hex", flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$"))),
        ("transitions", F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / n),
        ("distinct", F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(36.0))),
        ("vowel_pairs", share("(?i)[aeiou][bcdfghjklmnpqrstvwxyz](?=[aeiou])")),
        ("dictionary", 1 - F.length(F.regexp_replace(F.lower(c), DICTIONARY, "")) / n),
        ("format", flag(c.rlike(KEY_FORMAT))),
        ("uuid", flag(c.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"))),
        ("credential", flag(before.rlike(CREDENTIAL_WORD))),
        ("benign", flag(before.rlike(BENIGN_WORD))),
        ("assigned", flag(before.rlike("[:=]>?[\"' ]{0,2}$"))),
        ("quoted", flag(before.rlike("[\"']$") & after.rlike("^[\"']"))),
        ("address", flag(before.rlike(r"(://|www\.|[/?&.@#]|[?&]\w+=)$") | after.rlike(r"^([/?&@]|\.[A-Za-z])")
                         | (F.size(F.split(c, "/")) > 3))),
        ("words", flag(c.rlike("[_-]") & (share("[A-Za-z]") > 0.7))),
        ("test_path", flag(path.rlike(TEST_PATH))),
        ("punctuation", share(r"[^A-Za-z0-9+/_=\s-]")),
        ("spaces", share(r"\s")),
        ("value", flag(before.rlike(f"{ASSIGNED}$"))),
        ("tight", flag(before.rlike("[:=][\"'`]?$"))),
        ("url", flag(before.rlike(f"{URL_USER}$") & after.startswith("@"))),
        ("pem", flag(c.startswith("-----BEGIN "))),
        ("private", flag(c.rlike("^-----BEGIN [A-Z0-9 ]*PRIVATE KEY"))),
        ("reference", flag(c.rlike(REFERENCE))),
        ("prose", flag(c.rlike(PROSE))),
    ]


# ---------------------------------------------------------------- training set

def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """Findings with labels, derived from rules (see the module docstring)."""
    i = F.col("id")

    def text(*salt) -> Column:
        return F.concat(*[F.sha2(F.concat_ws("-", F.lit(str(s)), i.cast("string")), 256) for s in salt])

    def number(salt: int, below: int) -> Column:
        return F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(below)).cast("int")

    def pick(salt: int, *values: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), number(salt, len(values)))
    mixed = F.regexp_replace(F.base64(F.unhex(text(1, 2))), "[+/=]", "x")
    upper = F.translate(F.upper(text(3, 4)), "0189", "QZXW")
    hexed = text(5, 6)
    digits = F.regexp_replace(text(7, 8, 9), "[a-f]", "")
    prose = pick(10, "and then the ", "erhe of thtion ", "und der mit ", "de la que ", "see ", "", "in ", "line ")
    word = pick(11, "tionanderhe", "configuration", "internationalisation", "erheanthtion", "modelcheckpoint",
                "documentation", "schaftlichkeit", "mentecionalla")
    assign = pick(12, "=", " = ", ": ", "=\"", " = \"", "='")
    close = F.when(assign.endswith("\""), "\"").when(assign.endswith("'"), "'").otherwise("")
    kinds = [   # (before, candidate, after, label)
        (F.concat(prose, pick(13, "password", "passwd", "pwd", "db_password", "PASSWORD"), assign),
         F.left(hexed, 16 + number(14, 12)), F.concat(close, F.lit(" and")), 1),
        (F.concat(prose, pick(15, "token", "api_key", "secret", "auth_token", "apikey", "access_token"), assign),
         F.left(hexed, F.get(F.array(F.lit(32), F.lit(40), F.lit(64)), number(16, 3))), F.concat(close, F.lit(" ")), 1),
        (F.concat(prose, pick(17, "client_secret", "secret", "api key", "Bearer", "token"), assign),
         F.left(mixed, 20 + number(18, 20)), F.concat(close, F.lit("\n")), 1),
        (prose, F.concat(pick(19, "AKIA", "AKIA", "ASIA"), F.left(upper, F.lit(16))), pick(20, " the", " ", ".", ",", "\n"), 1),
        (prose, F.concat(pick(21, "ghp_", "gho_"), F.left(mixed, F.lit(36))), pick(22, " the", "\n"), 1),
        (F.concat(prose, pick(23, "key=", "", "stripe ")), F.concat(F.lit("sk_live_"), F.left(mixed, F.lit(24))), F.lit(" "), 1),
        (F.concat(prose, pick(24, "commit ", "sha1: ", "sha256:", "md5=", "checksum ", "digest: ", "rev ", "etag: \"")),
         F.left(hexed, F.get(F.array(F.lit(32), F.lit(40), F.lit(64)), number(25, 3))), F.lit(" the"), 0),
        (F.concat(prose, pick(26, "id=", "uuid: ", "guid ", "")),
         F.concat_ws("-", F.left(hexed, F.lit(8)), F.substring(hexed, 9, 4), F.substring(hexed, 13, 4),
                     F.substring(hexed, 17, 4), F.substring(hexed, 21, 12)), F.lit(" "), 0),
        (prose, F.left(digits, 16 + number(27, 6)), pick(28, "$$$", " ", "."), 0),
        (F.concat(prose, pick(29, "phone ", "card ", "isbn ", "order #")), F.left(digits, F.lit(16)), F.lit(" "), 0),
        (prose, F.concat(word, pick(30, "-", "_", ""), pick(31, "2024", "v2", "3", "10")), pick(32, ".", ",", " "), 0),
        (F.concat(prose, pick(33, "https://www.", "http://a.example.com/", "/usr/lib/", "img src=/")),
         F.concat(word, F.lit("/"), pick(34, "2023", "p1", "a7"), F.lit("/"), F.left(digits, F.lit(6))), pick(35, ".html", "?x=", " "), 0),
        (F.concat(prose, pick(36, "password=", "token = \"", "api_key: ", "secret=")),
         pick(37, "your-password-1234", "changeme-example-1", "example_token_0000", "xxxxxxxxxxxxxxxx1234",
              "test_placeholder_key_1", "dummy-secret-key-123"), F.lit(" "), 0),
        (prose, F.concat(word, word, F.left(digits, F.lit(2))), F.lit(" "), 0),
        (F.concat(prose, pick(38, "build ", "version ", "ref ")), F.left(hexed, 16 + number(39, 25)), F.lit(" "), 0),
    ]
    # short, letter-only and punctuated values of named credentials, URL passwords and PEM blocks, and what is like them
    stem = pick(41, "hunter", "Summer", "dragon", "S3cr3t", "monkey", "Tr0ub4dor", "pa55w0rd", "winter", "blue")
    mark = pick(42, "!", "&", "#", "$", "%", "@", "-", "!x", "*")
    tail = F.left(mixed, 2 + number(43, 10))
    short = F.get(F.array(F.concat(stem, F.left(digits, 1 + number(44, 4))),
                          F.concat(stem, mark, F.left(digits, 1 + number(44, 4))),
                          F.concat(stem, F.left(digits, F.lit(1)), mark, tail),
                          F.concat(tail, mark, F.left(upper, 1 + number(45, 6)))), number(46, 4))
    name = pick(47, "password", "db_password", "pwd", "passwd", "secret", "PASSWORD", "api_key", "passphrase", "token",
                "\"password\"", "auth_token")
    between = pick(48, "", "", " ", "-")
    phrase = F.concat(pick(49, "correct", "purple", "letme", "rainy", "open", "garden"), between,
                      pick(50, "horse", "window", "monday", "sesame", "river"), between,
                      pick(51, "battery", "staple", "lantern", "castle"), pick(52, "", "staple", "winter"))
    opened = pick(53, "=\"", " = \"", ": \"", "='", ": '")
    shut = F.when(opened.endswith("\""), "\"").otherwise("'")
    stand_in = pick(54, "your-password", "changeme", "<password>", "${DB_PASSWORD}", "********", "xxxxxxxx", "{{ secret }}",
                    "null", "None", "os.environ['DB_PW']", "process.env.TOKEN", "%s", "example", "getenv('PW')", "string",
                    "required", "true", "false", "REDACTED", "your_token_here", "test", "password", "secret")
    login = F.concat(prose, pick(55, "postgres", "https", "mysql", "redis", "amqp", "ftp"), F.lit("://"),
                     pick(56, "admin", "root", "svc_1", "", "user"), F.lit(":"))
    host = F.concat(F.lit("@"), pick(57, "db.host/x", "localhost:5432", "10.0.0.7/main", "example.org"))
    body = F.regexp_replace(F.repeat(F.concat(F.base64(F.unhex(text(58, 59, 60))), F.lit("\n")), 2 + number(61, 20)),
                            "\r", "")

    def pem(kind: Column, inside: Column) -> Column:
        return F.concat(F.lit("-----BEGIN "), kind, F.lit("-----\n"), inside, F.lit("-----END "), kind, F.lit("-----"))
    sealed = pick(62, "RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY", "ENCRYPTED PRIVATE KEY",
                  "PGP PRIVATE KEY BLOCK")
    kinds += [
        (F.concat(prose, name, assign), short, F.concat(close, F.lit(" ")), 1),
        (F.concat(prose, name, opened), short, F.concat(shut, F.lit("\n")), 1),
        (F.concat(prose, name, opened), phrase, F.concat(shut, F.lit("\n")), 1),
        (F.concat(prose, name, F.lit("=")), F.regexp_replace(phrase, " ", ""), pick(63, " ", "\n", ""), 1),
        (F.concat(prose, name, assign), stand_in, F.concat(close, F.lit(" ")), 0),
        (F.concat(prose, name, opened), stand_in, F.concat(shut, F.lit("\n")), 0),
        (F.concat(prose, name, pick(64, ": ", " = ", ": \"")),
         pick(65, "the", "never", "enter", "must", "is", "reset", "see", "click", "a", "forgotten", "please", "wrong"),
         pick(66, " ", ".", " it"), 0),
        (login, F.get(F.array(short, F.regexp_replace(phrase, " ", "")), number(67, 2)), host, 1),
        (login, stand_in, host, 0),
        (prose, pem(sealed, body), pick(68, "\n", "", "\""), 1),
        (prose, pem(pick(69, "CERTIFICATE", "PUBLIC KEY", "RSA PUBLIC KEY", "CERTIFICATE REQUEST", "PGP SIGNATURE",
                         "PGP PUBLIC KEY BLOCK"), body), pick(70, "\n", "", "\""), 0),
        (prose, pem(sealed, pick(71, "...\n", "<key>\n", "")), F.lit("\n"), 0),
    ]
    row = F.array(*[F.struct(b.alias("before"), c.alias("candidate"), a.alias("after"), F.lit(label).alias("label"))
                    for b, c, a, label in kinds])
    path = pick(40, "src/app/main", "config/prod.env", "notes", "", "tests/fixtures/data", "docs/example")
    # placeholders and examples stand in test paths as well as elsewhere
    return (spark.range(rows).select(F.get(row, F.pmod(i, F.lit(len(kinds))).cast("int")).alias("r"), path.alias("path"))
            .select("r.*", "path"))


# ---------------------------------------------------------------- forest

def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> list:
    """Random forest: bootstrap rows, a random third of the features per
    split (at least 4), Gini impurity. A tree is ``(feature, cut, left,
    right)`` (left: value <= cut) or a leaf's share of label 1."""
    rng = np.random.default_rng(seed)
    width = max(4, x.shape[1] // 3)

    def split(rows: np.ndarray, level: int):
        share = float(y[rows].mean())
        if level == 0 or len(rows) < 2 * LEAF or share in (0.0, 1.0):
            return share
        best = None
        for f in rng.permutation(x.shape[1])[:width]:
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, ones = x[order, f], np.cumsum(y[order])
            k = np.arange(LEAF, len(order) - LEAF + 1)
            k = k[v[k - 1] < v[k]] if len(k) and k[-1] < len(order) else k[:-1][v[k[:-1] - 1] < v[k[:-1]]]
            if not len(k):
                continue
            left, right = ones[k - 1] / k, (ones[-1] - ones[k - 1]) / (len(order) - k)
            gini = k * left * (1 - left) + (len(order) - k) * right * (1 - right)
            j = int(np.argmin(gini))
            if best is None or gini[j] < best[0]:
                best = (gini[j], int(f), float((v[k[j] - 1] + v[k[j]]) / 2))
        if best is None:
            return share
        _, f, cut = best
        low = x[rows, f] <= cut
        return f, cut, split(rows[low], level - 1), split(rows[~low], level - 1)
    return [split(rng.integers(0, len(y), len(y)), depth) for _ in range(trees)]


def forest_column(forest: list, features: list[Column]) -> Column:
    """Mean vote of the trees as one expression over the feature columns."""
    def tree(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(round(node, 4))
        f, cut, left, right = node
        return F.when(features[f] <= cut, tree(left)).otherwise(tree(right))
    total = tree(forest[0])
    for t in forest[1:]:
        total = total + tree(t)
    return total / len(forest)


def train(findings: DataFrame) -> list:
    """Grow the forest from labelled findings (collected: keep them few)."""
    named = feature_columns(F.col("before"), F.col("candidate"), F.col("after"), F.col("path"))
    rows = findings.select(*[c.alias(n) for n, c in named], "label").collect()
    data = np.array([tuple(r) for r in rows], dtype=float)
    return grow_forest(data[:, :-1], data[:, -1])


# ---------------------------------------------------------------- operator

def judged(text: Column, path: Column, forest: list, cut: float = CUT) -> Column:
    """Array over a text's candidates, in text order: ``candidate, score,
    is_secret``."""
    around = pieces(text)

    def one(c: Column, i: Column, between: Column) -> Column:
        named = feature_columns(F.get(between, i), c, F.get(between, i + 1), path)
        features = F.struct(*[v.alias(n) for n, v in named])
        return F.transform(F.array(features), lambda f: F.struct(
            c.alias("candidate"), forest_column(forest, [f[n] for n, _ in named]).alias("score")))[0]
    found = F.transform(F.array(around), lambda b: F.transform(candidates(text), lambda c, i: one(c, i, b)))[0]
    return F.transform(found, lambda f: F.struct(f["candidate"].alias("candidate"), f["score"].alias("score"),
                                                 (f["score"] >= cut).alias("is_secret")))


def _base(docs: DataFrame, text_col: str, path_col: str | None) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return text, F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")


def secret_scan(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                path_col: str | None = None, cut: float = CUT) -> DataFrame:
    """One row per candidate: ``doc_id, nth`` (0 for the text's first)``,
    length, preview`` (first four characters)``, sha256`` (of the candidate,
    so that reports hold no secrets)``, score, is_secret``."""
    forest = train(findings if findings is not None else labelled_findings(docs.sparkSession))
    text, path = _base(docs, text_col, path_col)
    found = (docs.select(F.col(id_col).alias("doc_id"), judged(text, path, forest, cut).alias("found"))
             .select("doc_id", F.posexplode("found").alias("nth", "f")))
    return found.select("doc_id", F.col("nth").cast("long").alias("nth"),
                        F.length("f.candidate").cast("long").alias("length"), F.left("f.candidate", F.lit(4)).alias("preview"),
                        F.sha2("f.candidate", 256).alias("sha256"), F.col("f.score").alias("score"),
                        F.col("f.is_secret").alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame | None = None, text_col: str = "text", path_col: str | None = None,
           cut: float = CUT, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mask``; other
    candidates and all other columns stay. Null texts stay null."""
    forest = train(findings if findings is not None else labelled_findings(docs.sparkSession))
    text, path = _base(docs, text_col, path_col)
    shown = F.transform(judged(text, path, forest, cut),
                        lambda f: F.when(f["is_secret"], F.lit(mask)).otherwise(f["candidate"]))
    joined = F.array_join(F.flatten(F.zip_with(pieces(text), shown, lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), "")
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), joined))
