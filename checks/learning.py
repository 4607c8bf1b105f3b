"""Text features, samples, training and scoring."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendweave import columns as C
from spendweave.functions import text
from spendweave.operators import sampling, vocabulary
from spendweave.operators.bayes import SparseBayes
from spendweave.plans import features, inference, training
from spendweave.session import materialize, shared_folder
from spendweave.sources import readers

from . import bind
from .bind import END, LEVELS, START, plain, query, with_tables
from .cleaning import SPELLED
from .coding import METRICS_SQL, confidence_sql, level_sql
from .merging import FEATURE_ROWS, RUN, STORED, inference_round

WORDS = 2000

TOKENS = r"""list_filter(string_split(lower(regexp_replace(text,
    '[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]', ' ', 'g')), ' '), lambda w: w <> '')"""
PLACES = f"""select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as pos
             from (select doc_id, {TOKENS} as ws from documents)"""
VOCABULARY = f"""
    select word, n, row_number() over (order by n desc, doc_id, pos) as idx
    from (select word, n, place.doc_id as doc_id, place.pos as pos
          from (select word, count(*) as n,
                       min(struct_pack(doc_id := doc_id, pos := pos)) as place
                from places group by word))
    qualify idx < {WORDS}"""
IDS = """
    select doc_id, list(idx order by pos) as ids
    from places join words using (word) group by doc_id"""


def documents(spark, d):
    return bind.table(spark, d, "documents")


def words(spark, d):
    return vocabulary.vocabulary(documents(spark, d), "text", "doc_id", WORDS)


@query("vocabulary", with_tables("", "select word, n as count, idx as index from words",
                                 places=PLACES, words=VOCABULARY))
def vocabulary_words(spark, d):
    return words(spark, d).withColumn("index", F.col("index").cast("bigint"))


@query("token_ids", with_tables("", """
    select doc_id, coalesce(array_to_string(ids, ' '), '') as ids
    from documents left join ids using (doc_id)""", places=PLACES, words=VOCABULARY, ids=IDS))
def token_ids(spark, d):
    found = vocabulary.token_ids(documents(spark, d), "text", words(spark, d))
    return found.select("doc_id", F.concat_ws(" ", F.col("ids").cast("array<string>"))
                        .alias("ids"))


@query("token_ids_joined", with_tables("", """
    select key, coalesce(array_to_string(ids, ' '), '') as ids
    from (select doc_id, case when doc_id % 3 = 0 then null else doc_id % 10 end as key
          from documents union all select doc_id, -1 from documents)
    left join ids using (doc_id)""", places=PLACES, words=VOCABULARY, ids=IDS))
def token_ids_joined(spark, d):
    """Rows whose keys repeat or are missing, and every text twice."""
    keyed = documents(spark, d).selectExpr(
        "text", "explode(array(case when doc_id % 3 = 0 then null else doc_id % 10 end, -1)) as key")
    found = vocabulary.token_ids(keyed, "text", words(spark, d))
    return found.select("key", F.concat_ws(" ", F.col("ids").cast("array<string>"))
                        .alias("ids"))


@query("pad_ids", with_tables("", """
    select doc_id, array_to_string(list_concat(kept, list_transform(range(50 - len(kept)),
                                   lambda x: 0)), ' ') as padded
    from (select doc_id, case when len(ids) > 50 then ids[-50:] else ids end as kept
          from ids)""", places=PLACES, words=VOCABULARY, ids=IDS))
def pad_ids(spark, d):
    found = vocabulary.token_ids(documents(spark, d), "text", words(spark, d))
    return found.where("size(ids) > 0").select("doc_id", F.concat_ws(
        " ", text.pad_ids(F.col("ids"), 50).cast("array<string>")).alias("padded"))


@query("sample_rows", """
    select o_orderkey, o_custkey from orders
    order by md5(concat_ws('|', '42', cast(o_orderkey as varchar))) limit 2500""")
def sample_rows(spark, d):
    return sampling.sample_rows(bind.table(spark, d, "orders").select("o_orderkey", "o_custkey"),
                                2500, by=["o_orderkey"])


@query("sample_repeated_rows", """
    select l_returnflag, l_linestatus from lineitem
    order by md5(concat_ws('|', '7', l_returnflag, l_linestatus)) limit 25000""")
def sample_repeated_rows(spark, d):
    flags = bind.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus")
    return sampling.sample_rows(flags, 25_000, seed=7)


@query("sample_with_replacement", """
    select 2 * count(*) as n, cast(0 as bigint) as foreign_rows, true as some_repeat, true as some_missing
    from orders""")
def sample_with_replacement(spark, d):
    """Twice as many draws as there are orders: how many came, and from where."""
    keys = bind.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    drawn = materialize(sampling.sample_with_replacement(keys, 2 * keys.count(), seed=7), "draws")
    foreign = drawn.join(keys, ["o_orderkey", "o_custkey"], "left_anti").agg(F.count("*").alias("foreign_rows"))
    facts = drawn.groupBy("o_orderkey").agg(F.count("*").alias("times")).agg(
        F.sum("times").alias("n"), (F.max("times") > 1).alias("some_repeat"), F.count("*").alias("kinds"))
    missing = facts.withColumn("some_missing", F.col("kinds") < keys.count())
    return missing.select("n", F.lit(foreign.first()[0]).alias("foreign_rows"), "some_repeat", "some_missing")


@query("split_tail", """
    select o_orderkey, case when rn > n - cast(floor(n * 0.1) as bigint) then 'validation'
                            else 'training' end as part
    from (select o_orderkey, count(*) over () as n, row_number() over
              (order by md5(concat_ws('|', '42', cast(o_orderkey as varchar)))) as rn
          from orders)""")
def split_tail(spark, d):
    fitting, held_back = sampling.split_tail(
        bind.table(spark, d, "orders").select("o_orderkey"), 0.1)
    return (fitting.withColumn("part", F.lit("training"))
            .unionByName(held_back.withColumn("part", F.lit("validation"))))


OPTIONS = training.TrainingOptions(label="lang", threshold=110, sample=None, num_words=WORDS,
                                   text_length=20)


def labelled(spark, d):
    """Documents as training rows with their language as the label."""
    return documents(spark, d).select("doc_id", F.col("text").alias("DESCRIPTION"), "lang")


@query("training_features", with_tables("", f"""
    select doc_id, idx as label_index, array_to_string(list_concat(kept, list_transform(
               range(20 - len(kept)), lambda x: 0)), ' ') as ids,
           array_to_string(list_transform(range(k), lambda j: case when j = idx then '1'
                           else '0' end), '') as hot
    from (select doc_id, lang, case when len(ids) > 20 then ids[-20:] else coalesce(ids, []) end
                   as kept from kept_documents left join ids using (doc_id))
    join (select lang, row_number() over (order by lang) - 1 as idx, count(*) over () as k
          from (select distinct lang from kept_documents)) using (lang)""",
    kept_documents="""select * from documents where lang in
        (select lang from documents group by lang having count(*) >= 110)""",
    places=PLACES.replace("from documents", "from kept_documents"), words=VOCABULARY, ids=IDS))
def training_features(spark, d):
    rows = training.balanced_sample(labelled(spark, d), OPTIONS, parts=["DESCRIPTION"],
                                    row_key="doc_id")
    ready = training.training_features(rows, OPTIONS, "doc_id")
    return ready.select(
        "doc_id", F.col("label_index").cast("bigint").alias("label_index"),
        F.concat_ws(" ", F.col("ids").cast("array<string>")).alias("ids"),
        F.array_join(vector_to_array("label_vector").cast("array<int>").cast("array<string>"),
                     "").alias("hot"))


NUM_WORDS = 20_001

#: Split of ``kept`` as the seeded sample does it.
SPLIT = """select *, count(*) over () as n, row_number() over
               (order by md5(concat_ws('|', '42', cast(doc_id as varchar)))) as rn from kept"""
FITTING = "select doc_id, label from split where rn <= n - cast(floor(n * 0.1) as bigint)"
HELD_BACK = "select doc_id, label from split where rn > n - cast(floor(n * 0.1) as bigint)"


def bayes_sql(levels=()) -> dict[str, str]:
    """Multinomial naive Bayes over weighted word counts, from ``fit (doc_id, label)``,
    ``rest (doc_id)`` and ``places``: every text against every child of its class."""
    widths = levels or (99,)
    ctes = {
        "fit_words": "select label, doc_id, word, count(*) as tf from places join fit using (doc_id) group by all",
        "vocab": f"""select word, cast(round(ln(((select count(*) from fit) + 1.0) / (count(*) + 1.0)) * 1e9) as bigint)
                         as idf from fit_words group by word order by sum(tf) desc, word limit {NUM_WORDS - 1}""",
        "counted": "select label, word, sum(tf) as n, any_value(idf) as idf from fit_words join vocab using (word) "
                   "group by label, word",
        "found": "select doc_id, word, count(*) as tf, any_value(idf) as idf from places join rest using (doc_id) "
                 "join vocab using (word) group by doc_id, word",
        "at0": """select doc_id, '' as node, coalesce(cast(x as double), 0) / 1e9 as x, cast(1 as double) as p
                  from rest left join (select doc_id, sum(tf * idf) as x from found group by doc_id) using (doc_id)""",
    }
    for k, width in enumerate(widths):
        up, down = f"substr(label, 1, {widths[k - 1] if k else 0})", f"substr(label, 1, {width})"
        ctes |= {
            f"sums{k}": f"""select {up} as node, {down} as child, word, sum(n) * (any_value(idf) / 1e9) as s,
                                   any_value(idf) / 1e9 as idf from counted group by {up}, {down}, word""",
            f"totals{k}": f"select node, child, sum(cast(round(s * 1e9) as hugeint)) as total from sums{k} group by all",
            f"sizes{k}": f"select {up} as node, {down} as child, count(*) as rows from fit group by all",
            f"classes{k}": f"""
                select node, child, ln(rows + 1.0) - ln(sum(rows) over (partition by node)
                           + cast(count(*) over (partition by node) as double)) as prior,
                       ln(coalesce(cast(total as double), 0) / 1e9 + (select count(*) from vocab)) as slope
                from sizes{k} left join totals{k} using (node, child)""",
            f"shared{k}": f"""
                select doc_id, child, sum(tf * cast(round(s.idf * ln(s + 1.0) * 1e9) as bigint)) as w
                from at{k} join found f using (doc_id) join sums{k} s on s.node = at{k}.node and s.word = f.word
                group by doc_id, child""",
            f"scores{k}": f"""
                select a.doc_id, a.x, a.p, c.child, prior - a.x * slope + coalesce(cast(w as double), 0) / 1e9 as score
                from at{k} a join classes{k} c on c.node = a.node
                left join shared{k} h on h.doc_id = a.doc_id and h.child = c.child""",
            f"at{k + 1}": f"""
                select doc_id, arg_min(child, (-round(score, 9), child)) as node, any_value(x) as x,
                       any_value(p) / sum(exp(score - top)) as p
                from (select *, max(score) over (partition by doc_id) as top from scores{k}) group by doc_id""",
        }
    return ctes | {"predicted": "select doc_id, node as predicted_label, round_even(p, 3) as predicted_label_proba "
                                f"from at{len(widths)}"}


#: Item texts and codes; a code counts with eight digits.
ITEM_PARTS = ("DESCRIPTION", "MANUFACTURER_NAME", "SUPPLIER_PART")
LEGAL = "length(CODE) = 8 and CODE <> '00000000'"
KEPT_ITEMS = """select doc_id, text, label from coded
    where label in (select label from coded group by label having count(*) >= 12)"""
CODED_ITEMS = f"""select ID as doc_id, concat_ws(' ', {', '.join(ITEM_PARTS)}) as text, CODE as label
                  from items where {LEGAL}"""
ITEM_PLACES = PLACES.replace("from documents", "from kept")
ITEM_OPTIONS = training.TrainingOptions(threshold=12, sample=None, num_words=NUM_WORDS)
LEVEL_WIDTHS = ITEM_OPTIONS.levels
ITEM_TABLES = {"coded": CODED_ITEMS, "kept": KEPT_ITEMS, "places": ITEM_PLACES, "split": SPLIT,
               "fit": FITTING, "rest": HELD_BACK}


def coded_items(spark, d):
    return bind.items(spark, d).where(LEGAL).select("ID", "CODE", *ITEM_PARTS)


@query("train_classifier", with_tables(
    "items", METRICS_SQL, **ITEM_TABLES, **bayes_sql(),
    pairs="select label as a, predicted_label as b from rest join predicted using (doc_id)"))
def train_classifier(spark, d):
    """Metrics of a classifier of item codes, on held-back rows."""
    _, metrics = training.train(coded_items(spark, d), ITEM_OPTIONS, ITEM_PARTS, "ID")
    return metrics


@query("train_by_level", with_tables(
    "items", " union all ".join(
        f"select {n} as digits, * from ({METRICS_SQL.replace('pairs', f'pairs{n}')})" for n in LEVEL_WIDTHS),
    **ITEM_TABLES, **bayes_sql(LEVEL_WIDTHS),
    **{f"pairs{n}": f"select substr(label, 1, {n}) as a, substr(predicted_label, 1, {n}) as b "
                    "from rest join predicted using (doc_id)" for n in LEVEL_WIDTHS}))
def train_by_level(spark, d):
    """The same codes classified down the levels; metrics of each level."""
    _, metrics = training.train(coded_items(spark, d), replace(ITEM_OPTIONS, classifier="top_down"), ITEM_PARTS, "ID")
    return metrics


#: A code for every document, among 499 full ones.
DOCUMENT_CODE = bind.digits("(doc_id % 499)")
DOCUMENT_OPTIONS = training.TrainingOptions(imbalance=None, sample=None, num_words=NUM_WORDS)
DOCUMENT_TABLES = {"fit": f"select doc_id, {DOCUMENT_CODE} as label from documents",
                   "rest": "select doc_id, label from fit", "places": PLACES}
PREDICTED = "select doc_id, label as CODE, predicted_label, predicted_label_proba from rest join predicted using (doc_id)"


def scored_documents(spark, d, options):
    table = documents(spark, d).select("doc_id", F.col("text").alias("DESCRIPTION"),
                                       F.expr(DOCUMENT_CODE).alias("CODE"))
    rows = training.balanced_sample(table, options, parts=["DESCRIPTION"], row_key="doc_id")
    model = training.fit_classifier(rows, options)
    return training.score(model, rows).select("doc_id", "CODE", "predicted_label", "predicted_label_proba")


@query("score_documents", with_tables("", PREDICTED, **DOCUMENT_TABLES, **bayes_sql()))
def score_documents(spark, d):
    """Predicted code and probability of every document; its words are more than are kept."""
    return scored_documents(spark, d, DOCUMENT_OPTIONS)


@query("score_by_level", with_tables("", PREDICTED, **DOCUMENT_TABLES, **bayes_sql(LEVEL_WIDTHS)))
def score_by_level(spark, d):
    """The same, down the levels."""
    return scored_documents(spark, d, replace(DOCUMENT_OPTIONS, classifier="top_down"))


#: A label that every text has: one of some two thousand codes, by its content.
TEXT_LABEL = bind.digits("(length(CONCAT_FEATURE) * 131 + ascii(substr(CONCAT_FEATURE, 3, 1)) * 7 "
                         "+ ascii(substr(CONCAT_FEATURE, 9, 1)))")


@query("infer_with_model", with_tables("item_table", f"""
    select t.ID, {', '.join(
        f'case when a.HIT then a.UNSPSC_{level} else t.SBN_PREDICATED_UNSPSC_{level} end '
        f'as SBN_PREDICATED_UNSPSC_{level}, cast(case when a.HIT then a.CONFIDENCE_{level} '
        f'else t.SBN_PREDICTION_CONFIDENCE_{level} end as double) '
        f'as SBN_PREDICTION_CONFIDENCE_{level}' for level in LEVELS)},
        case when a.HIT then 'M1' else t.MODEL_UUID end as MODEL_UUID
    from item_table t left join (
        select f.ID, true as HIT, answers.* from feature_rows f join answers using (CONCAT_FEATURE)
        ) a on t.ID = a.ID and (t.MODEL_UUID is null or t.MODEL_UUID <> 'M1')""",
    feature_rows=FEATURE_ROWS, stored=STORED,
    documents="select distinct CONCAT_FEATURE as doc_id, CONCAT_FEATURE as text, CONCAT_FEATURE, "
              f"{TEXT_LABEL} as label from feature_rows",
    places=PLACES, fit="select doc_id, label from documents",
    rest="select doc_id, label from documents where length(CONCAT_FEATURE) % 3 <> 0", **bayes_sql(LEVEL_WIDTHS),
    answers=f"""
        select * from stored union all
        select CONCAT_FEATURE, {level_sql('label')}, {confidence_sql('label', 'p')},
               timestamp '{RUN}', 'M1'
        from (select doc_id as CONCAT_FEATURE, predicted_label as label,
                     cast(predicted_label_proba as decimal(6,5)) as p from predicted)"""))
def infer_with_model(spark, d):
    """A classifier is fitted on the texts of the batch, and the batch scored with it, level by
    level; the model is saved and loaded in between."""
    texts = inference.feature_rows(bind.item_table(spark, d), START, END).select(
        "CONCAT_FEATURE").distinct()
    options = training.TrainingOptions(num_words=NUM_WORDS, classifier="top_down")
    rows = materialize(texts.withColumn("CODE", F.expr(TEXT_LABEL)), "texts")
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    training.fit_classifier(rows, options).save(path)
    model = SparseBayes.load(spark, path)
    merged, _ = inference_round(spark, d, lambda features: training.score(model, features))
    return plain(merged.select(*[name for name in C.OWN_PREDICTION
                                 if name != "SBN_PREDICTION_LASTUPDATED_AT"]))


_COLUMNS = ("SUPPLIER_ORG", "BUYER_ORG", "PO_ITEM_ID", "DESCRIPTION", "SUPPLIER_PART",
            "MANUFACTURER_PART", "MANUFACTURER_NAME", "ITEM_TYPE", "IS_ADHOC")


def _unified(name: str) -> str:
    value = f"coalesce(cast({name} as varchar), 'N/A')"
    return f"case when {value} in ({SPELLED}) then 'N/A' else {value} end as {name}"


@query("training_table", with_tables("items commodity", f"""
    select * exclude (ID) from (
        select * from (
            select ID, {', '.join(_unified(name) for name in _COLUMNS)}, CODE,
                   substr(CODE, 1, 2) as SEGMENT, substr(CODE, 3, 2) as FAMILY,
                   substr(CODE, 5, 2) as CLASS, substr(CODE, 7, 2) as COMMODITY
            from items where regexp_full_match(CODE, '[0-9]{{8}}') and CODE <> '00000000'
              and substr(CODE, 1, 2) <> '00' and substr(CODE, 3, 2) <> '00'
              and substr(CODE, 5, 2) <> '00' and CODE in (select CODE from commodity))
        where not contains(DESCRIPTION, 'N/A') and not contains(PO_ITEM_ID, 'N/A')
        qualify row_number() over (partition by PO_ITEM_ID order by ID) = 1)
    qualify row_number() over (partition by SUPPLIER_ORG, BUYER_ORG, DESCRIPTION, SUPPLIER_PART,
        MANUFACTURER_PART, MANUFACTURER_NAME, ITEM_TYPE, IS_ADHOC, CODE order by ID) = 1"""))
def training_table(spark, d):
    """Community files and the code reference through CSV, then legal codes and cleaning."""
    folder = f"{shared_folder(spark)}/inputs-{uuid.uuid4().hex}"
    rows = bind.items(spark, d).select("ID", *[F.col(name).cast("string") for name in _COLUMNS],
                                       "CODE")
    inputs = {}
    for number in (1, 3):
        path = f"{folder}/community_{number}"
        part = rows.where(F.expr(f"cast(PO_ITEM_ID as bigint) % 2 = {number // 2}"))
        part.write.options(header=True, escape='"', compression="gzip").csv(path)
        inputs[f"{readers.COMMUNITY}{number}"] = {"path": path}
    reference = f"{folder}/reference"
    bind.commodity(spark, d).select("CODE").write.option("header", True).csv(reference)
    inputs[readers.REFERENCE] = {"path": reference}
    loaded, codes = readers.load_training_inputs(
        inputs, spark, schema=", ".join(f"{name} string" for name in rows.columns),
        reference_schema="CODE string")
    config = features.TRAINING_CLEANING
    keep_id = features.Cleaning(
        {"select": ["ID", *config.select_cols_instructions["select"]]}, config.handle_str_na_vals,
        config.drop_duplicates_instructions, config.handle_missing_vals)
    return features.training_table(loaded, codes, keep_id, ["ID"]).drop("ID")
