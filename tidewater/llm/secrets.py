"""Secret scans: wide candidate search, then a random forest that removes false findings. DataFrame and SQL functions only.

A candidate is a run of ``least`` or more letters, digits and ``+/_=.-`` that holds a digit, within a word (between ASCII
white space); all such runs of a word are candidates, as in JSON or code without spaces. Its features: length, share and number of changes between character classes, distinct characters, share of hex
digits, share of its letter runs that the dictionary covers, a hash of the path's folder and test-like path names, whether
the words before it name a credential or assign, and the length of its neighbours. The forest learns from labelled
findings, any table of candidates with a ``label``; ``fit`` takes at most ``most`` of them, those of least hash.

The dictionary is that of all texts, whole. Null and empty texts have no candidates; a null id is a value like any other. Several equal candidates in one text are reported each, with their word number
and the run's number in the word. A null path counts as empty. Repeated rows give repeated findings. Empty tables give empty results, and with findings of
one label only, no forest is fitted and the label decides.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import checkpointed, lookup

SPACE = r"[\x20\x09-\x0D]+"
NAMES = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer)"
#: Characters of a neighbouring word in which a name is looked for.
NEAR = 256
FEATURES = ["f_length", "f_changes", "f_change_share", "f_distinct", "f_hex", "f_digits", "f_upper", "f_covered", "f_test_path", "f_folder", "f_named", "f_assigned", "f_quoted", "f_before", "f_after"]


def candidates(docs: DataFrame, least: int = 16, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Per candidate: ``id``, ``path``, ``word_no``, ``run_no``, ``candidate`` (the run itself), ``lead`` (what stands before it in its word,
    back to the last candidate or run), ``word`` (the lead, the run and what stands up to the next run), the two words before and
    the one after, as far as ``NEAR`` characters, and the lengths of the nearest two.

    A part of a word is given to two candidates at most, so a whole file in one word is not copied for each of its runs.
    """
    run = rf"[A-Za-z0-9+/_=.-]{{{least},}}"
    words = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.split(F.col(text_col), SPACE).alias("words"))
    marked = F.transform("words", lambda w, i: F.when((F.length(w) >= least) & w.rlike(run) & w.rlike(r"\d"), i))
    found = words.withColumn("at", F.filter(marked, lambda i: i.isNotNull())).where(F.size("at") > 0)
    word = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    last = lambda text: F.right(text, F.lit(NEAR))
    near = F.transform("at", lambda i: F.struct(i.cast("long").alias("word_no"), word(i).alias("whole"), last(word(i - 2)).alias("before2"), last(word(i - 1)).alias("before"), F.left(word(i + 1), F.lit(NEAR)).alias("after"), F.length(word(i - 1)).alias("n_before"), F.length(word(i + 1)).alias("n_after")))
    rows = found.select("id", "path", F.explode(near).alias("c")).select("id", "path", "c.*")
    # zipped, as a lambda that names the arrays would have them made anew for each run
    runs, gaps = F.regexp_extract_all("whole", F.lit(run), F.lit(0)), F.split("whole", run, -1)
    zipped = F.arrays_zip(runs.alias("candidate"), F.concat(F.array(F.lit("")), runs).alias("last"), gaps.alias("gap"), F.slice(F.concat(gaps, F.array(F.lit(""))), 2, F.size(gaps)).alias("trail"))
    own = rows.select("*", F.posexplode(zipped).alias("run_no", "r")).drop("whole").where(F.col("r.candidate").rlike(r"\d"))
    lead = F.concat(F.when(F.col("r.last").rlike(r"\d"), "").otherwise(F.col("r.last")), F.col("r.gap"))
    return own.select("*", F.col("r.candidate").alias("candidate"), lead.alias("lead"), F.concat(lead, "r.candidate", "r.trail").alias("word")).drop("r").withColumn("run_no", F.col("run_no").cast("long"))


def with_features(found: DataFrame, dictionary: DataFrame | None) -> DataFrame:
    """Candidates with the forest's features. ``dictionary`` (word, docs) may be of any size: the letter runs of candidates are looked up in it by a join. Checkpointed."""
    c = F.col("candidate")
    found = checkpointed(found.withColumn("__c", F.monotonically_increasing_id()))
    if dictionary is None:
        found = found.withColumn("__covered", F.lit(0))
    else:
        runs = found.select("__c", F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
        held = lookup(runs, dictionary.select("word", "docs"), "word", "docs").where("docs is not null").groupBy("__c").agg(F.sum(F.length("word")).alias("__covered"))
        found = found.join(held, "__c", "left")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    changes = F.regexp_count(classes, F.lit("(?<=a)[^a]|(?<=A)[^A]|(?<=0)[^0]|(?<=[^aA0])[aA0]"))
    size = F.length(c).cast("double")
    own = F.concat("lead", "candidate")
    context = F.concat_ws(" ", "before2", "before", "lead", F.regexp_replace(own, r"[+/_=.-]?[A-Za-z0-9+/_.-]{16,}.*$", ""), F.regexp_extract(own, r"^(.*?)=", 1))
    share = lambda p: F.regexp_count(c, F.lit(p)) / size
    values: dict[str, Column] = {
        "f_length": size,
        "f_changes": changes,
        "f_change_share": changes / size,
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))),
        "f_hex": share("[0-9a-fA-F]"),
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_covered": F.coalesce("__covered", F.lit(0)) / size,
        "f_test_path": F.col("path").rlike("(?i)test|example|sample|fixture|docs?/").cast("int"),
        "f_folder": F.pmod(F.xxhash64(F.regexp_replace("path", "/[^/]*$", "")), F.lit(16)),
        "f_named": context.rlike(NAMES).cast("int"),
        "f_assigned": F.concat_ws(" ", "before", F.regexp_extract(own, r"^[^=:]*[=:]", 0)).rlike("[=:]$|[=:] ").cast("int"),
        "f_quoted": F.col("word").rlike("[\"'`]").cast("int"),
        "f_before": F.col("n_before"),
        "f_after": F.col("n_after"),
    }
    return found.withColumns({k: v.cast("double") for k, v in values.items()}).drop("__c", "__covered")


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels for a table that has none: a finding is true if a credential is named and assigned before a mixed run."""
    named = F.concat_ws(" ", "before2", "before", F.concat("lead", "candidate")).rlike(NAMES + r"[\"']?\s*[=:]")
    mixed = F.col("candidate").rlike("[A-Za-z]") & F.col("candidate").rlike("[0-9].*[0-9].*[0-9]")
    return found.withColumn("label", (named & mixed).cast("double"))


def dictionary_of(docs: DataFrame, least: int = 5, text_col: str = "text") -> DataFrame:
    """(word, docs): every word of three letters or more that ``least`` documents or more hold. All texts are counted, those of null id too."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit("[a-z]{3,}"), F.lit(0)))).alias("word"))
    return checkpointed(words.groupBy("word").agg(F.count("*").alias("docs")).where(F.col("docs") >= least))


def fit(labelled: DataFrame, most: int = 4000, trees: int = 20, depth: int = 6) -> RandomForestClassificationModel | float:
    """A forest from findings with features and a ``label``, half of ``most`` of each label; or the one label there is."""
    order = [F.xxhash64("id", "word_no"), F.col("id"), F.col("word_no"), F.col("run_no")]
    sample = labelled.where("label = 1").orderBy(*order).limit(most // 2).unionByName(labelled.where("label = 0").orderBy(*order).limit(most // 2)).coalesce(1)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample).select("features", "label")
    kinds = [r.label for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, maxBins=32).fit(rows).copy()  # a copy has no training summary, which holds the session and does not go to executors


def scan(found: DataFrame, model: RandomForestClassificationModel | float, threshold: float = 0.5) -> DataFrame:
    """Findings with ``probability`` and ``secret``; nothing is shuffled."""
    if isinstance(model, float):
        return found.withColumn("probability", F.lit(model)).withColumn("secret", F.lit(model >= threshold))
    rows = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found).drop("probability"))
    return rows.withColumn("probability", vector_to_array("probability")[1]).withColumn("secret", F.col("probability") >= threshold).drop("features", "rawPrediction", "prediction")
