"""Labelled findings for the secret scan: texts made by rule, each with one value that is a secret or is none.

There is no table of reviewed findings among the inputs, so the forest learns from these. Values are drawn
by hash of a row number; the words around them are frequent words of the corpus that is scanned. What is a
secret is decided by how a value was made, and not by any feature of it.
"""

from __future__ import annotations

from itertools import cycle

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number of texts; a bound on the labelled findings that the default forest is fitted to.
TEXTS = 9_000
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_BASE62 = _UPPER + _LOWER + _DIGIT
# How credentials are named and assigned, and what stands where one is missing.
_NAMES = (
    "password", "passwd", "pwd", "Password", "DB_PASSWORD", "dbPassword", "passphrase", "secret", "client_secret",
    "SECRET_KEY", "token", "access_token", "auth_token", "api_key", "apikey", "API-KEY", "access_key", "credential",
)
_SIGNS = ("=", " = ", ": ", ":", " := ", " => ", "==")
_PLACEHOLDERS = (
    "changeme", "changeme123", "your_password", "YOUR_TOKEN_HERE", "your-api-key", "<password>", "<your token>",
    "${PASSWORD}", "${DB_PASS}", "$PASSWORD", "%s", "%(password)s", "{{ secret }}", "{password}", "null", "None",
    "nil", "true", "false", "undefined", "xxxx", "xxxxxxxx", "XXXXXXXXXXXX", "********", "***", "........", "example",
    "example123", "EXAMPLE_TOKEN", "sample-token", "dummy_value1", "placeholder", "todo", "TBD", "n/a", "string", "str",
    "required", "optional", "getPassword()", "get_token(user)", 'os.environ["TOKEN"]', "process.env.API_KEY",
    "config.password", "self.token", "args.secret", "request.form", "input()", "1", "12", "42", "2048", "0", "-", "--",
)
_CHECKSUMS = ("commit ", "revision ", "sha256: ", "sha1 ", "md5sum ", "checksum ", "digest: ", "uuid ", "etag ", "guid ")
_NEAR = ("the token is ", "bearer ", "use this api key ", "my password is ", "log in with the secret ", "credential ")
_SHORT = ("v2", "mp3", "3rd", "2nd", "h264", "covid19", "utf8", "b2b", "4k", "1080p", "x86_64", "a4", "f1", "web2.0", "g20")
_EXTENSIONS = (".html", ".png", ".jpg", ".pdf", ".txt", ".csv", ".js", ".py", ".tar.gz", ".php")


class _Draws:
    """Random values of a row, each draw under a name of its own."""

    def __init__(self, seed: int):
        self.seed, self.made = seed, 0
        # A few words that all values share; taken in turn, so that those of one value differ.
        self.made_words = cycle([self._made_word() for _ in range(6)])
        self.words = cycle([self._word() for _ in range(10)])

    def number(self, below: int, *more: Column) -> Column:
        self.made += 1
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(self.made), F.col("_id"), *more), F.lit(below)).cast("int")

    def pick(self, options) -> Column:
        """One of the options; only that one is worked out."""
        drawn, options = self.number(len(options)), [o if isinstance(o, Column) else F.lit(o) for o in options]
        chosen = F.when(drawn == 0, options[0])
        for i, option in enumerate(options[1:], 1):
            chosen = chosen.when(drawn == i, option)
        return chosen

    def text(self, alphabet: str, least: int, most: int | None = None) -> Column:
        """From ``least`` to ``most`` characters."""
        size = F.lit(least) if most is None else self.number(most - least + 1) + least
        self.made += 1
        name, n = self.made, len(alphabet)

        def letter(i: Column) -> Column:
            at = F.pmod(F.xxhash64(F.lit(self.seed), F.lit(name), F.col("_id"), i), F.lit(n)).cast("int")
            return F.substring(F.lit(alphabet), at + 1, F.lit(1))

        # A sequence from 1 to 0 would count down.
        return F.array_join(F.transform(F.slice(F.sequence(F.lit(0), size), 2, size), letter), "")

    def _made_word(self) -> Column:
        """A word of two syllables."""
        syllables = [self.text(letters, 1) for _ in range(2) for letters in ("bcdfghklmnprstvz", "aeiou")]
        return F.concat(*syllables, self.text("nrstl", 1))

    def _word(self) -> Column:
        """A frequent word of the corpus, or a made one where it has none."""
        place = self.number(1 << 30) % F.greatest(F.size("common"), F.lit(1))
        return F.coalesce(F.get("common", place), self.made_word())

    def made_word(self) -> Column:
        return next(self.made_words)

    def word(self) -> Column:
        return next(self.words)


def _part(lead: Column | str, value: Column, tail: Column | str = "") -> Column:
    texts = {"lead": lead, "value": value, "tail": tail}
    return F.struct(*[(t if isinstance(t, Column) else F.lit(t)).alias(name) for name, t in texts.items()])


def _secrets(d: _Draws) -> list[Column]:
    """(lead, value, tail) of secrets."""
    named = F.concat(d.pick(_NAMES), d.pick(_SIGNS))
    typing = cycle([d.pick([d.word(), d.made_word(), F.initcap(d.made_word())]) for _ in range(3)])
    typed = lambda: next(typing)
    bare = [
        d.text(_BASE62, 8, 40),
        d.text("0123456789abcdef", 16, 64),
        F.concat(d.text(_BASE62, 6, 12), d.text("!#$%&*+-", 1, 2), d.text(_BASE62, 2, 8)),
        F.concat(typed(), d.text(_DIGIT, 1, 4)),
        F.concat(typed(), d.text(_DIGIT, 1, 3), d.text(_BASE62, 1, 3)),
        F.concat(typed(), d.text("!#$%&*_", 1), typed(), d.text(_DIGIT, 1, 4)),
        F.concat(F.translate(typed(), "aeo", "@30"), d.text("!#$", 0, 2), F.translate(typed(), "eis", "31$"), d.text(_DIGIT, 1, 2)),
        F.concat(*[d.made_word() for _ in range(4)]),
        F.concat(*[d.word() for _ in range(4)], d.made_word()),
        F.concat_ws("-", d.made_word(), d.word(), d.made_word(), d.text(_DIGIT, 1, 3)),
    ]
    phrases = [
        F.concat_ws(" ", d.word(), d.text(_DIGIT, 1, 2), d.word(), d.made_word()),
        F.concat_ws(" ", F.translate(typed(), "aeos", "@30$"), d.word(), d.made_word(), d.made_word()),
    ]
    quote, wrapped = d.pick(['"', "'"]), d.pick(["", "", '"', "'"])
    shown = _part(F.concat(named, wrapped), d.pick(bare), F.concat(wrapped, d.pick(["", "", ".", ","])))
    cloud = F.concat(d.pick(["AKIA", "ASIA"]), d.text(_UPPER + "234567", 16))
    prefixed = d.pick([
        F.concat(F.lit("ghp_"), d.text(_BASE62, 36)), F.concat(F.lit("sk_live_"), d.text(_BASE62, 24)),
        F.concat(F.lit("AIza"), d.text(_BASE62 + "-_", 35)),
        F.concat(F.lit("xoxb-"), d.text(_DIGIT, 11), F.lit("-"), d.text(_BASE62, 24)),
        F.concat(F.lit("eyJ"), d.text(_BASE62, 20), F.lit(".eyJ"), d.text(_BASE62, 40), F.lit("."), d.text(_BASE62, 43)),
        F.concat(F.lit("ghp_"), *[d.text(_BASE62, 4)] * 9),
    ])
    pem = F.concat(
        F.lit("-----BEGIN "), d.pick(["", "RSA ", "EC "]), F.lit("PRIVATE KEY-----\n"), d.text(_BASE62 + "+/", 6, 400),
        F.lit("\n-----END PRIVATE KEY-----"),
    )
    led = d.pick(["", "", F.concat(d.pick(["key", "GH", "aws_access_key_id", "id"]), d.pick(["=", ": ", " "]))])
    return [
        shown, shown, shown,
        _part(F.concat(named, quote), d.pick(phrases), quote),
        _part(
            F.concat(d.pick(["postgres", "mysql", "https", "redis", "amqp"]), F.lit("://"), d.made_word(), F.lit(":")),
            d.pick([d.text(_BASE62, 6, 20), F.concat(typed(), d.text(_DIGIT, 1, 3)), typed(), F.concat(typed(), typed())]),
            F.concat(F.lit("@"), d.made_word(), d.pick([".internal/prod", ":5432/", ".net"])),
        ),
        _part(led, cloud, d.pick(["", ".", ","])),
        _part(led, prefixed),
        _part(d.pick(["", "key: ", "\n"]), pem),
        _part(d.pick(_NEAR), F.concat(d.text(_BASE62, 16, 40), d.text(_DIGIT, 1), d.text(_LOWER, 1))),
    ]


def _others(d: _Draws) -> list[Column]:
    """(lead, value, tail) of values that look like secrets and are none."""
    named = F.concat(d.pick(_NAMES), d.pick(_SIGNS))
    hexadecimal = "0123456789abcdef"
    same = d.pick(["x", "X", "0", "A", "1", "a"])
    quote = d.pick(['"', "'"])
    uuid = F.concat_ws("-", *[d.text(hexadecimal, n) for n in (8, 4, 4, 4, 12)])
    address = F.concat(d.made_word(), d.pick([".", "_", ""]), d.text(_DIGIT, 1, 3), F.lit("@"), d.made_word(), d.text(_DIGIT, 1), d.pick([".example.com", ".org", ".net"]))
    path = F.concat(d.pick(["/usr/lib/", "/var/www/", "~/", "./", "C:/"]), d.made_word(), F.lit("/"), d.made_word(), d.text(_DIGIT, 1, 4), d.pick(["", "/", *_EXTENSIONS]))
    link = F.concat(d.pick(["https://", "http://", "www."]), d.made_word(), d.text(_DIGIT, 0, 2), d.pick([".org/", ".example.com/"]), d.made_word(), F.lit("/"), d.text(_BASE62, 2, 12), d.text(_DIGIT, 1), d.pick(["", *_EXTENSIONS]))
    date = F.concat_ws("-", F.concat(F.lit("20"), d.text(_DIGIT, 2)), F.concat(F.lit("0"), d.text("123456789", 1)), d.text("12", 2))
    plain = [
        address, path, link, date, F.concat(date, F.lit("T1"), d.text(_DIGIT, 1), F.lit(":20:30")), d.text(_DIGIT, 1, 19),
        F.concat_ws(".", *[d.text("123456789", 1, 3) for _ in range(3)], d.text(_DIGIT, 1)),
        F.concat(F.lit("+"), d.text(_DIGIT, 2), F.lit("-"), d.text(_DIGIT, 3), F.lit("-"), d.text(_DIGIT, 4, 7)),
        F.concat(d.pick(["chapter", "image", "page", "user", "file", "v", "no"]), d.pick(["", "-", "_"]), d.text(_DIGIT, 1, 8)),
        F.concat(d.word(), F.lit("-"), d.word(), F.lit("-"), d.text(_DIGIT, 2, 6), d.pick(_EXTENSIONS)),
        F.concat(d.text(_UPPER, 2, 3), F.lit("-"), d.text(_DIGIT, 3, 6), F.lit("-"), d.text(_DIGIT, 2)),
        d.pick(_SHORT), F.concat(d.word(), d.text(_DIGIT, 1, 4)), F.concat(d.text(_DIGIT, 1, 4), d.pick(["px", "kg", "th", "GB", "%"])),
        d.text(_BASE62, 12, 30), F.concat(d.text("123456789", 1, 3), F.lit(":"), d.text("12345", 2)),
    ]
    short = [F.substring(d.word(), 1, 12), F.initcap(d.word()), d.made_word(), F.initcap(d.made_word()), F.substring(F.upper(d.word()), 1, 12)]
    fixed_example = d.pick([
        F.concat(F.lit("AKIA"), d.text(_UPPER + "234567", 9), F.lit("EXAMPLE")),
        F.concat(d.pick(["AKIA", "ASIA"]), F.repeat(F.upper(same), F.lit(16))),
        F.concat(F.lit("ghp_"), F.repeat(same, F.lit(36))), F.concat(F.lit("ghp_"), F.repeat(F.lit("your"), F.lit(9))),
        F.concat(F.lit("sk_live_"), F.repeat(same, F.lit(24))), F.concat(F.lit("AIza"), F.repeat(same, F.lit(35))),
        F.concat(F.lit("sk_live_"), d.text(_BASE62, 9), F.lit("EXAMPLE")), F.concat(F.lit("xoxb-"), F.repeat(same, F.lit(20))),
    ])
    common = d.pick(plain)
    return [
        _part(d.pick(["", "key ", "id=", "e.g. "]), fixed_example),
        _part(d.pick(_CHECKSUMS), d.pick([d.text(hexadecimal, 40), d.text(hexadecimal, 64), d.text(hexadecimal, 32), F.concat(d.text(hexadecimal, 6, 11), d.text(_DIGIT, 1)), uuid])),
        _part(d.pick(["", "see ", "id ", "at "]), common, d.pick(["", " ", ","])),
        _part("", common),
        _part(d.pick(["", "", "id ", "see ", "session ", "at "]), F.concat(d.text(_BASE62, 10, 40), d.text(_DIGIT, 1)), d.pick(["", ",", "."])),
        _part(named, d.pick(_PLACEHOLDERS)),
        _part(F.concat(named, quote), d.pick([p for p in _PLACEHOLDERS if '"' not in p]), quote),
        _part(named, d.pick(short)),
        _part(F.concat(d.pick(_NAMES), d.pick([": ", " = "])), d.pick(short)),
        _part(
            F.concat(d.pick(["https", "postgres", "ftp"]), F.lit("://"), d.pick(["user", "username", "admin"]), F.lit(":")),
            d.pick(["xxxx", "xxxxx", "your_password", "<password>", "changeme", "${PASSWORD}", "******", "$PASS", "example"]),
            d.pick(["@localhost", "@example.com", "@db"]),
        ),
        _part(F.concat(named, quote), F.concat_ws(" ", d.word(), d.word(), d.word(), d.word()), quote),
    ]


def labelled_texts(common: DataFrame, texts: int = TEXTS, seed: int = 29) -> DataFrame:
    """(text, value, label): ``texts`` rows, half of them with a secret.

    ``common`` is one row with an array of frequent words, empty if the corpus has none. The same seed and
    words give the same rows.
    """
    d = _Draws(seed)
    rows = common.sparkSession.range(texts).withColumnRenamed("id", "_id").join(F.broadcast(common.select("common")))
    around = [F.concat_ws(" ", *[d.word() for _ in range(4)]) for _ in range(2)]
    alone = d.number(4) == 0
    made = rows.select(
        (F.col("_id") % 2).cast("double").alias("label"),
        F.when(F.col("_id") % 2 == 1, d.pick(_secrets(d))).otherwise(d.pick(_others(d))).alias("made"),
        *[F.when(alone, F.lit("")).otherwise(words).alias(name) for name, words in zip(("_before", "_after"), around, strict=True)],
    )
    text = F.concat(F.col("_before"), F.lit(" "), "made.lead", "made.value", "made.tail", F.lit(" "), F.col("_after"))
    return made.select(text.alias("text"), F.col("made.value").alias("value"), "label")
