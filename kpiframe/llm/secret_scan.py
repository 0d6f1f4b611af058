"""Secret scans: candidates by pattern, false positives removed by a forest.

A candidate is a run of 16 or more of ``[A-Za-z0-9+/=_-]`` with a digit, inside
a word; a name and its ``=`` at the start of the run are split off the value and
belong to what leads it. The lead reaches back to the candidate before, the tail
on to the next one, and the name is the one next to the value. What is assigned
to a name that means a secret is a candidate too, whatever its length, digits
and other characters, up to the end of its quotes or word. A random forest judges it by its length, the transitions between kinds
of characters, how much of it a dictionary covers, the path it was found under
and its neighbouring words. The forest is trained on labelled findings
(candidate columns and ``label`` 0/1), a bounded sample of ``SAMPLE_ROWS`` of
each label, and turned into one SQL expression: extraction, features and
scores are DataFrame functions only.

``documents`` brings no labelled findings, so ``op2_secret_scan`` labels its
candidates by the form reviewers accept at sight: a value assigned to a name
that means a secret, quoted or right behind the ``=``, and keys of well-known
forms are secrets; runs without name and quotes are none where they lack
variety (one kind of character, few different ones, or dictionary words), and
otherwise unlabelled. ``source`` stands for the path.

Such negatives look nothing like a secret, and from them alone the forest
learns that whatever varies is one. So it also learns from ``made_findings``:
random values in ``HARMLESS`` surroundings (hashes and UUIDs in prose or after
a harmless name, parts of URLs, identifiers, stand-ins like ``$OTHER``, and
names like ``author`` that hold a secret's word) with label 0, and the same
kinds of values in ``SECRET`` surroundings with label 1.

Not covered: secrets of several words beyond the first; names and values more
than two words apart (``password: str = "..."``); lists of secrets beyond the
first; passwords inside URLs (``user:password@host``); unnamed runs shorter than
16 characters or without a digit, unless a secret's name stands before them.

Defined cases: null and empty texts have no candidates; a null path counts as
empty; a neighbour that is not there is an empty word; repeated rows give their
findings each; with labels of one kind only, every score is that label, and
without labels 0; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, documents, materialise

RUN = "[A-Za-z0-9+/=_-]{16,}"
SECRET_NAME = "(?i)(token|secret|passw|pwd|credential|bearer|auth|api_?key|access_?key|private_?key)"
#: What joins a name to its value, with the quotes and brackets around it.
JOIN = r"""[\\"'`\])]{0,4}(?:=>|:=|={1,3}|:)"""
OPEN = r"""[\\"'`(\[]{0,4}"""
#: Names that hold a word of SECRET_NAME and mean no secret.
OTHER_NAME = "(?i)(author(?!i)|tokeni[sz]|secretar)"
#: What a secret's name assigns: up to the closing quote, or to a delimiter.
VALUE = (r"""((?<=["'`])[^"'`\s]+?(?=\\?(?:["'`]|$))|"""
         r"""[^\s"'`,;&<>(){}\[\]\\]*[^\s"'`,;&<>(){}\[\]\\.:!?])""")
_BEGIN = r"""\\?[(\[]?(?:[bBrRuUfF](?=["']))?\\?(?:"{3}|'{3}|["'`](?!["'`]))?"""
_KEY = SECRET_NAME.replace("(?i)(", "(?i:") + r"[\w.-]{0,40}"
_JOINT = "(?:=>|:=|={1,3}|:)"
#: A name with its join, from the start of its run, and its value.
NAMED = "(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{0,80}?" + _KEY + JOIN + _BEGIN + ")" + VALUE
#: A value, or its join and itself, at the start of a word that follows its name.
FOLLOWS = "^(?!(?i:bearer|basic|token)$)((?:" + _JOINT + ")?+" + _BEGIN + ")" + VALUE
LONG = ("(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/=_-]{16})(?=[A-Za-z+/=_-]*+[0-9])"
        "([A-Za-z0-9+/=_-]*=(?=[A-Za-z0-9+/_-]))?+([A-Za-z0-9+/_-]++=*+)")
#: Keys that their own form gives away.
KNOWN = (r"^((AKIA|ASIA)[A-Z0-9]{16}|gh[opsur]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w-]{20,}|xox[abeprs]-[\w-]{10,}|"
         r"[rs]k_live_[A-Za-z0-9]{16,}|sk-[\w-]{20,}|AIza[\w-]{35}|npm_[A-Za-z0-9]{36})$")
#: Values that stand for a secret without being one.
STAND_IN = r"(?i)^(none|null|true|false|string|changeme|required|x+|\*+|\.+|[$%<{].*|your.*)$"
HARMLESS_NAME = "(?i)(sha|md5|commit|checksum|digest|hash|uuid|card|phone|order|isbn|version)"
HARMLESS_PATH = "(?i)(test|example|sample|mock|fixture|doc)"
#: Words that a readable identifier is made of.
DICTIONARY = ("about", "account", "address", "after", "build", "cache", "class", "client", "code", "config", "content",
              "data", "default", "dev", "document", "error", "example", "field", "file", "first", "format", "from",
              "function", "group", "header", "home", "http", "image", "index", "info", "item", "last", "link", "list",
              "local", "main", "message", "method", "model", "name", "node", "number", "object", "order", "page",
              "param", "path", "product", "project", "query", "release", "report", "request", "response", "result",
              "sample", "server", "service", "session", "source", "state", "string", "style", "system", "table",
              "test", "text", "that", "the", "this", "time", "title", "type", "update", "user", "value", "version",
              "view", "web", "with", "world", "year")
SAMPLE_ROWS = 4000
TREES = 21
DEPTH = 7
SEED = 11
#: Names of made secrets, and surroundings (earlier, before, lead, tail, after)
#: of made findings with the forms of value that stand in them. ``{name}`` is
#: one of the names; ``{w}`` any word of the dictionary.
NAMES = ("token", "api_key", "password", "SECRET_KEY", "AWS_SECRET_ACCESS_KEY", "auth_token", "db.passwd", "private_key")
SECRET = (
    ("{name}", "=", '"', '"', "{w}", "hex40 hex32 base64 short words"),
    ("{w}", "{w}", '{name}="', '"', "{w}", "hex40 hex64 base64 short words"),
    ("{w}", "{w}", "{name}='", "'", "", "hex40 base64 short words"),
    ("", "{w}", '"{name}":"', '",', "{w}", "hex40 uuid base64 short words"),
    ("{w}", '"{name}":', '"', '"', "{w}", "hex40 base64 short words"),
    ("{w}", "{name}:", "'", "',", "{w}", "hex32 base64 short words"),
    ("", "", "{name}=", "", "", "hex40 base64 short"),
    ("", "export", "{name}=", "", "{w}", "hex40 hex64 base64 short"),
    ("{w}", "{w}", "--{name}=", "", "{w}", "hex40 base64 short"),
    ("Authorization:", "Bearer", "", "", "{w}", "hex40 base64"),
    ("{w}", "{w}", "", "", "{w}", "known"),
)
HARMLESS = (
    ("{w}", "{w}", "", "", "{w}", "hex40 hex64 hex32 uuid ident digits"),
    ("{w}", "{w}", "", ".", "{w}", "hex40 uuid ident"),
    ("{w}", "{w}", "(", ")", "{w}", "hex40 uuid digits"),
    ("{w}", "commit", "", "", "{w}", "hex40 hex32"),
    ("{w}", "sha256:", "", "", "{w}", "hex64"),
    ("", "{w}", "sha256:", "", "{w}", "hex64"),
    ("{w}", "{w}", 'commit="', '"', "{w}", "hex40 uuid"),
    ("{w}", "{w}", "checksum=", "", "{w}", "hex40 hex64"),
    ("{w}", '"id":', '"', '"', "{w}", "uuid hex32"),
    ("", "{w}", "https://{w}.", "", "{w}", "slug"),
    ("{w}", "{w}", "https://{w}.org/", "", "{w}", "slug words uuid hex40"),
    ("{w}", "{w}", "http://www.{w}.net/?page=", "", "{w}", "hex32 ident"),
    ("", "", "{name}=", "", "", "stand_in"),
    ("{name}", "=", '"', '"', "{w}", "stand_in"),
    ("{w}", "{w}", '"{name}":"', '"', "{w}", "stand_in"),
    ("{w}", "{w}", '"author":"', '"', "{w}", "person words short"),
    ("author", "=", '"', '"', "{w}", "person words"),
    ("{w}", "{w}", "tokenizer='", "'", "{w}", "ident words"),
    ("{w}", "{w}", 'file="', '"', "{w}", "ident slug words"),
)
#: Random values that each of the made surroundings is filled with.
MADE = 60


def follows(word: Column, before: Column, earlier: Column) -> Column:
    """Whether the word starts with what a name before it is assigned."""
    named, ends = _KEY + JOIN + "$", _KEY + r"""[\\"'`\])]{0,4}$"""
    joined = before.rlike(named) | (before.rlike(f"^{_JOINT}$") & earlier.rlike(ends)) | (
        before.rlike("""(?i)^["'`]?(bearer|basic|token)$""") & earlier.rlike(named))
    return (joined | (word.rlike("^" + _JOINT) & before.rlike(ends))) & word.rlike(FOLLOWS)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, place (of the word), run (within the word), candidate and
    its neighbours before, earlier and after; lead and tail of its own word."""
    words = (docs.where(F.col("text").rlike("[0-9]") | F.col("text").rlike(SECRET_NAME))
             .select("doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                     F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
                     F.col("text").rlike(SECRET_NAME).alias("names")))
    near = lambda i: F.when((i >= 1) & (i <= F.size("words")), F.element_at("words", F.greatest(i, F.lit(1)))).otherwise("")
    word = lambda i: F.element_at("words", i)
    wanted = F.filter(F.sequence(F.lit(1), F.size("words")), lambda i: (
        (F.length(word(i)) >= 16) & word(i).rlike("[0-9]") & word(i).rlike(RUN))
        | (F.col("names") & (word(i).rlike(NAMED) | follows(word(i), near(i - 1), near(i - 2)))))
    found = F.transform(F.when(F.size("words") > 0, wanted), lambda i: F.struct(
        i.alias("place"), word(i).alias("word"), near(i - 1).alias("before"),
        near(i - 2).alias("earlier"), near(i + 1).alias("after")))
    hits = words.select("doc_id", "path", F.explode(found).alias("hit")).select("doc_id", "path", "hit.*")
    # candidates between \x01 and \x02: gap, candidate, gap, candidate, ... gap
    plain = F.translate("word", "\x01\x02", "  ")
    marked = F.when(
        follows(F.col("word"), F.col("before"), F.col("earlier")),
        F.regexp_replace(plain, "|".join((NAMED, FOLLOWS, LONG)), "$1$3$5\x01$2$4$6\x02")).otherwise(
        F.regexp_replace(plain, "|".join((NAMED, LONG)), "$1$3\x01$2$4\x02"))
    pieces = F.split(marked, "[\x01\x02]", -1)
    piece = lambda i: F.get("pieces", i)
    # a candidate that the next one is assigned to is that one's name as well
    key = lambda i: (i > 2) & (piece(i - 1).rlike("""^["'`\\]]{0,2}[:=]""") | (
        piece(i - 1).rlike("""^["'`]$""") & piece(i - 2).endswith("=")))
    lead = lambda i: F.when(key(i), F.concat(piece(i - 2), piece(i - 1))).otherwise(piece(i - 1))
    runs = F.when(F.size("pieces") > 1, F.transform(
        F.sequence(F.lit(1), F.size("pieces") - 1, F.lit(2)), lambda i: F.struct(
            piece(i).alias("candidate"), lead(i).alias("lead"), piece(i + 1).alias("tail"))))
    return (hits.withColumn("pieces", pieces).select("*", F.posexplode(runs).alias("run", "r"))
            .select("doc_id", "path", "place", "run", "r.candidate", "before", "earlier", "after", "r.lead", "r.tail"))


def name() -> Column:
    """The words that name a candidate: of an assignment its own name, else
    what stands before it, without assignments that have their value."""
    own = F.regexp_extract("lead", r"([\w.+/-]+)" + JOIN + OPEN + "$", 1)
    free = lambda c: F.when(F.col(c).rlike("""[=:]["'`]?[^"'`=:]"""), "").otherwise(F.col(c))
    return (F.when(own != "", own)
            .when(F.col("run") > 0, F.col("lead"))
            .when(F.col("lead").rlike("^[=:]"), F.col("before"))
            .when(F.col("before").rlike("^[=:>]+$"), F.col("earlier"))
            .when(F.col("before").rlike(JOIN + "$"), F.col("before"))
            .otherwise(F.concat_ws(" ", free("earlier"), free("before"), "lead")))


def readable() -> Column:
    """The share of a candidate that the dictionary covers."""
    n, words = F.length("candidate"), "(" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")"
    return (n - F.length(F.regexp_replace(F.lower("candidate"), words, ""))) / n


def assigned() -> Column:
    return F.when(F.col("run") > 0, F.col("lead").rlike("[=:]")).otherwise(F.concat("before", "lead").rlike("[=:]"))


def features() -> dict[str, Column]:
    c, n = F.col("candidate"), F.length("candidate")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("double")
    names = name()
    return {
        "length": n.cast("double"),
        "digits": count("[0-9]") / n,
        "capitals": count("[A-Z]") / n,
        "small": count("[a-z]") / n,
        "to_digit": count("[A-Za-z](?=[0-9])") / n,
        "from_digit": count("[0-9](?=[A-Za-z])") / n,
        "case_changes": (count("[a-z](?=[A-Z])") + count("[A-Z](?=[a-z])")) / n,
        "repeats": count(r"(.)\1") / n,
        "distinct": F.size(F.array_distinct(F.split(c, ""))).cast("double") / n,
        "hexadecimal": flag(c.rlike("^[0-9a-fA-F]+$")),
        "dictionary": readable(),
        "harmless_path": flag(F.col("path").rlike(HARMLESS_PATH)),
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "secret_name": flag(names.rlike(SECRET_NAME)),
        "harmless_name": flag(names.rlike(HARMLESS_NAME)),
        "assigned": flag(assigned()),
        "known_form": flag(c.rlike(KNOWN)),
        "quoted": flag(F.col("lead").rlike("[\"']") & F.col("tail").rlike("[\"']")),
        "shell": flag(F.col("lead").rlike(r"[\w.-]=$")),
        "url": flag(F.col("lead").rlike("://")),
        "uuid": flag(c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "hash_length": flag(c.rlike("^([0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")),
        "stand_in": flag(c.rlike(STAND_IN)),
        "other_name": flag(names.rlike(OTHER_NAME)),
        "sentence": flag(F.col("before").rlike("^[A-Za-z]+[.,;]?$") & F.col("after").rlike("^[A-Za-z]+[.,;]?$")),
    }


def with_features(found: DataFrame) -> DataFrame:
    return found.withColumn("f", F.struct(*[v.alias(k) for k, v in features().items()]))


def tree_sql(lines: list[str], names: list[str]) -> str:
    """A tree, printed as indented If/Else/Predict lines, as a SQL expression."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return line.split(":")[1].strip()
    feature, cut = re.fullmatch(r"If \(feature (\d+) <= ([-\d.Ee]+)\)", line).groups()
    yes = tree_sql(lines, names)
    lines.pop(0)
    no = tree_sql(lines, names)
    return f"if(f.{names[int(feature)]} <= {float(cut)!r}D, {yes}, {no})"


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """``labelled``: candidates with ``label`` 0/1. The forest, or the one label
    (0 if there is none) where there are not both."""
    rank = F.md5(F.concat_ws("|", F.lit("findings"), F.col("doc_id").cast("string"), "place", "run", "candidate"))
    names = list(features())
    known = with_features(labelled.where("label is not null").withColumn("rank", rank))
    some = known.where("label = 0").orderBy("rank").limit(sample_rows).unionByName(
        known.where("label = 1").orderBy("rank").limit(sample_rows))
    some = materialise(some.select("rank", "label", "f.*").coalesce(1).sortWithinPartitions("rank"))
    labels = {int(r[0]) for r in some.select("label").distinct().collect()}
    if len(labels) < 2:
        return float(max(labels, default=0))
    rows = VectorAssembler(inputCols=names, outputCol="x").transform(
        some.coalesce(1).select(F.col("label").cast("double").alias("label"), *names))
    return RandomForestClassifier(featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                  featureSubsetStrategy="sqrt").fit(rows)


def score_sql(forest) -> str:
    """The forest's score, the share of trees that vote for a secret, as SQL
    over the struct ``f``."""
    if isinstance(forest, float):
        return f"{forest}D"
    names = list(features())
    votes = [tree_sql([x for x in t.toDebugString.splitlines()[1:] if x.strip()], names) for t in forest.trees]
    return "(" + " + ".join(votes) + f") / {len(votes)}D"


def made_findings(spark: SparkSession, made: int = MADE, seed: int = SEED) -> DataFrame:
    """Labelled findings, ``made`` of each surrounding and form of value."""
    word = lambda i: F.element_at(F.array(*map(F.lit, DICTIONARY)), (
        F.pmod(F.xxhash64("hex", F.lit(i)), F.lit(len(DICTIONARY))) + 1).cast("int"))
    pick = lambda of: F.element_at(F.array(*map(F.lit, of)), (F.pmod(F.xxhash64("hex"), F.lit(len(of))) + 1).cast("int"))
    part = lambda at, n: F.substring("hex", at, n)
    code = F.translate(F.base64(F.unhex(part(1, 48))), "+/", "Zq")
    digit = part(60, 1)
    forms = {
        "hex32": part(1, 32), "hex40": part(1, 40), "hex64": F.col("hex"), "base64": code,
        "uuid": F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
        "short": F.concat(word(1), F.substring(code, 1, 3), F.lit("7")),
        "words": F.concat_ws("-", word(1), word(2), word(3)),
        "slug": F.concat_ws("/", F.lit("com"), word(1), F.lit("2024"), F.concat_ws("-", word(2), word(3), word(4), digit)),
        "ident": F.concat_ws("_", word(1), word(2), word(3), F.lit("2")),
        "digits": F.substring(F.translate("hex", "abcdef", "123456"), 1, 18),
        "person": F.initcap(word(1)),
        "stand_in": pick(("$OTHER", "${SECRET_1}", "%TOKEN%", "changeme", "None", "your-key-here", "<token>", "xxxxxxxx", "true")),
        "known": pick(("AKIA", "ASIA")),
    }
    forms["known"] = F.concat(forms["known"], F.upper(part(1, 16)))
    around = ("earlier", "before", "lead", "tail", "after")
    kinds = [F.struct(F.lit(k).alias("kind"), F.lit(label).alias("label"), F.lit(form).alias("form"),
                      *[F.lit(text).alias(c) for c, text in zip(around, texts)])
             for k, (label, (*texts, which)) in enumerate([(1, x) for x in SECRET] + [(0, x) for x in HARMLESS])
             for form in which.split()]
    values = materialise(
        spark.range(made).select("id", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("hex"))
        .select("id", F.create_map(*[x for k, v in forms.items() for x in (F.lit(k), v)]).alias("forms"),
                pick(NAMES).alias("name"), F.array(*[word(10 + i) for i in range(len(around))]).alias("w")))
    filled = [F.replace(F.replace(F.col(c), F.lit("{name}"), F.col("name")), F.lit("{w}"), F.col("w")[i]).alias(c)
              for i, c in enumerate(around)]
    return materialise(values.select("*", F.inline(F.array(*kinds))).select(
        F.concat_ws(":", F.lit("made"), "kind", "id").alias("doc_id"), F.lit("").alias("path"), F.lit(1).alias("place"),
        F.lit(0).alias("run"), F.element_at("forms", F.col("form")).alias("candidate"), *filled, "label"))


def scan(docs: DataFrame, labelled_by: Column, path: str = "source", more: DataFrame | None = None) -> DataFrame:
    """All findings with score and verdict. ``labelled_by`` labels candidates
    (0, 1 or null); the forest learns from the labelled ones, and from ``more``
    labelled findings of the same columns (null: only from the first)."""
    found = materialise(candidates(docs, path))
    labelled = found.withColumn("label", labelled_by)
    if more is not None:
        labelled = labelled.withColumn("doc_id", F.col("doc_id").cast("string")).unionByName(more)
    score = score_sql(fit(labelled))
    return with_features(found).select(
        "doc_id", "place", "run", "candidate", F.expr(f"cast({score} as double)").alias("score")).withColumn(
            "is_secret", F.col("score") >= 0.5)


def obvious() -> Column:
    """The label that reviewers give at sight: 1 to keys of a well-known form
    and to a value assigned to a name that means a secret, where it is quoted or
    follows its ``=`` at once; 0 to what has neither a name nor quotes nor
    variety, and to what is assigned to a harmless name; else null."""
    c = F.col("candidate")
    names = name().rlike(SECRET_NAME)
    quoted = F.col("lead").rlike("[\"']") & F.col("tail").rlike("[\"']")
    shell = F.col("lead").rlike(r"[\w.-]=$") & c.rlike("[0-9]")
    real = (F.length(c) >= 6) & ~c.rlike(STAND_IN) & ~name().rlike(OTHER_NAME)
    varied = c.rlike("[A-Za-z]") & c.rlike("[0-9]") & (readable() < 0.5) & (
        F.size(F.array_distinct(F.split(c, ""))) >= 8)
    return F.when(c.rlike(KNOWN) | (names & (quoted | shell) & assigned() & real), 1).when(
        ~names & ~quoted & F.when(assigned(), name().rlike(HARMLESS_NAME)).otherwise(~varied), 0)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir), obvious(), more=made_findings(spark))
