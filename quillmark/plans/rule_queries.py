"""Rule tables, texts of claims, revisions and validators over the check tables.

The corpus has none of the field's words, so each document's whole text is led by a
phrase that its number picks.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import field
from ..functions import text as X
from ..operators import aggregates, nested
from ..operators import rules as R
from ..operators import screening as S
from .catalog import query, table
from .text_queries import COLLAPSE, STRIP, TITLE

PHRASES = (
    "A randomised trial of remission induction in adults with ulcerative colitis", "Guideline on Crohn disease", "Consensus on IBD diets, a European view", "Quality of life and relapse: a systematic review", "Maintenance of remission in children",
    "A prospective cohort of healthy persons in Canada (n = 512)", "Faecal calprotectin as a biomarker", "Conclusion: fibre can result in fewer symptoms", "10 Alcohol Included 84 adults from the United Kingdom", "Overall, diet can influence risk of developing IBD",
    "RESULTS: Adverse events and safety", "Best practice advice 4: adherence among 230 patients", "Importantly: it proved to lower inflammation", "Malnutrition in inflammatory bowel disease, multicentre", "Meta-analysis of American studies", "",
)
_LIST = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in PHRASES) + "]"
CASES = f"x AS (SELECT doc_id, source, {_LIST}[doc_id % {len(PHRASES)} + 1] || ' ' || coalesce(text, '') AS claim, {_LIST}[doc_id % {len(PHRASES)} + 1] AS title, text FROM documents), k AS (SELECT *, lower(claim) AS t, lower(title) AS ti, CASE WHEN doc_id % 9 = 0 THEN 'randomized controlled trial' WHEN doc_id % 7 = 0 THEN 'observational study' ELSE '' END AS ty FROM x)"


def cases(spark, d):
    lead = F.get(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % len(PHRASES)).cast("int"))
    types = F.when(F.col("doc_id") % 9 == 0, "randomized controlled trial").when(F.col("doc_id") % 7 == 0, "observational study").otherwise("")
    rows = table(spark, d, "documents").select("doc_id", "source", F.concat(lead, F.lit(" "), F.coalesce("text", F.lit(""))).alias("claim"), lead.alias("title"), types.alias("types"), "text")
    return rows.withColumn("t", F.lower("claim"))


def _has(words, column) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _sql_rule(rule, **columns) -> str:
    if rule.either:
        return "(" + " OR ".join(_has(words, columns[name]) for name, words in rule.either) + ")"
    return "(" + " AND ".join(_has(words, columns["text"]) for words in rule.needs) + ")"


def sql_first_label(rules, default, **columns) -> str:
    return "CASE " + " ".join(f"WHEN {_sql_rule(r, **columns)} THEN '{r.label}'" for r in rules) + f" ELSE '{default}' END"


def sql_all_labels(rules, default, text) -> str:
    found = "list_filter([" + ", ".join(f"CASE WHEN {_sql_rule(r, text=text)} THEN '{r.label}' END" for r in rules) + "], lambda v: v IS NOT NULL)"
    return f"coalesce(nullif(array_to_string({found}, ', '), ''), '{default}')"


_LEVELS = ", ".join(f"('{k}', '{v[0]}', '{v[1]}')" for k, v in R.STUDY_LEVEL.items())


@query("study_rules", f"""WITH {CASES}, s AS (SELECT doc_id, {sql_first_label(R.STUDY, R.STUDY_DEFAULT, title='ti', types='ty')} AS study FROM k), l(study, level, "group") AS (VALUES {_LEVELS}) SELECT doc_id, study, level, "group" FROM s JOIN l USING (study)""")
def study_rules(spark, d):
    return cases(spark, d).select("doc_id", R.study(F.lower("title"), F.col("types")).alias("s")).select("doc_id", "s.*")


@query("condition_labels", f"WITH {CASES} SELECT doc_id, {sql_all_labels(R.CONDITION, 'unclear', 't')} AS conditions FROM k")
def condition_labels(spark, d):
    return cases(spark, d).select("doc_id", F.array_join(R.all_labels(R.CONDITION, "unclear", F.col("t")), ", ").alias("conditions"))


@query("outcome_labels", f"WITH {CASES} SELECT doc_id, {sql_first_label(R.OUTCOME, R.OUTCOME_DEFAULT, text='t')} AS outcome, {sql_first_label(R.OUTCOME_TYPE, 'disease_activity', text='t')} AS outcome_type FROM k")
def outcome_labels(spark, d):
    t = F.col("t")
    return cases(spark, d).select("doc_id", R.first_label(R.OUTCOME, R.OUTCOME_DEFAULT, text=t).alias("outcome"), R.first_label(R.OUTCOME_TYPE, "disease_activity", text=t).alias("outcome_type"))


SIZE = (r"(?i)\b(?:n\s*=\s*|included\s+)([0-9]{2,7})\b", r"(?i)\b([0-9]{2,7})\s+(?:patients|participants|individuals|subjects)\b")


@query("population_region", f"""WITH {CASES} SELECT doc_id, {sql_first_label(R.POPULATION, R.POPULATION_DEFAULT, text='t')} AS population, {sql_all_labels(R.REGION, 'Not reported in abstract', 't')} AS region,
coalesce(nullif(regexp_extract(claim, '{SIZE[0]}', 1), ''), nullif(regexp_extract(claim, '{SIZE[1]}', 1), ''), 'Not reported in extracted metadata') AS sample_size FROM k""")
def population_region(spark, d):
    found = [F.nullif(F.regexp_extract("claim", p, 1), F.lit("")) for p in SIZE]
    return cases(spark, d).select(
        "doc_id", R.first_label(R.POPULATION, R.POPULATION_DEFAULT, text=F.col("t")).alias("population"), F.array_join(R.all_labels(R.REGION, "Not reported in abstract", F.col("t")), ", ").alias("region"),
        F.coalesce(*found, F.lit("Not reported in extracted metadata")).alias("sample_size"),
    )


@query("source_status", f"WITH {CASES} SELECT doc_id, CASE WHEN doc_id % 17 = 0 OR doc_id % 23 = 0 THEN 'superseded_replaced' WHEN length(text) < 500 THEN 'verified_abstract_only' WHEN contains(ti, 'guideline') THEN 'verified_guideline' ELSE 'verified_full_text' END AS status FROM k")
def source_status(spark, d):
    by = F.when(F.col("doc_id") % 17 == 0, F.concat(F.lit("doc-"), F.col("doc_id") + 1))
    status = F.when(F.col("doc_id") % 23 == 0, "superseded").otherwise("current")
    return cases(spark, d).select("doc_id", R.source_status(R.superseded(by, status), F.length("text") < 500, F.contains(F.lower("title"), F.lit("guideline"))).alias("status"))


@query("claim_texts", f"""WITH {CASES} SELECT doc_id, concat_ws(chr(10), nullif(source, ''), nullif(title, ''), nullif(claim, '')) AS retrieval, source || ': ' || coalesce(nullif(title, ''), claim) AS embedding, 'source_text' AS kind, sha256(claim) AS digest FROM k""")
def claim_texts(spark, d):
    c = F.col
    return cases(spark, d).select("doc_id", R.retrieval_text(c("source"), c("title"), c("claim")).alias("retrieval"), R.embedding_text(c("source"), c("title"), c("claim")).alias("embedding"), R.untrusted(c("claim")).alias("u")).select("doc_id", "retrieval", "embedding", "u.kind", F.sha2("u.content", 256).alias("digest"))


PAYLOAD = ["claimId", "claimText", "topic", "sourceId", "sourceUrl", "exactLocator", "supportingExcerpt", "limitations", "applicabilityLimitations", "evidenceLevel", "confidence", "outcomeType", "population", "diseaseContext", "plainLanguageExplanation"]


@query("claim_payload", f"WITH {CASES} SELECT doc_id::VARCHAR AS claimId, coalesce(nullif(title, 'Adverse events and safety'), '') AS claimText, source AS topic, {', '.join(f"'' AS {c}" for c in PAYLOAD[3:])} FROM k")
def claim_payload(spark, d):
    rows = cases(spark, d).select(F.col("doc_id").alias("claimId"), F.nullif(F.col("title"), F.lit("Adverse events and safety")).alias("claimText"), F.col("source").alias("topic"))
    return R.payload(rows, PAYLOAD)


_SOFT = "p"
for _pattern, _new in R.SOFTER.items():
    _SOFT = f"regexp_replace({_SOFT}, '{_pattern}', '{_new}', 'g')"
_NOTES = " || ".join("CASE WHEN " + (_has(words, "lower(p)") if what == "text" else f"ot IN ({', '.join(repr(w) for w in words)})") + f" THEN '{note.replace(chr(39), chr(39) * 2)}' ELSE '' END" for what, words, note in R.NOTES)
_OPEN = COLLAPSE.format("claim")
for _pattern in field.OPENINGS:
    _OPEN = "regexp_replace(" + _OPEN + ", '" + _pattern.replace("'", "''") + "', '')"


@query("proposed_revision", f"""WITH {CASES}, o AS (SELECT doc_id, {STRIP.format(_OPEN)} AS p, {sql_first_label(R.OUTCOME_TYPE, 'disease_activity', text='t')} AS ot FROM k), s AS (SELECT doc_id, p, ot, {_SOFT} AS t FROM o)
SELECT doc_id, CASE WHEN p = '' THEN '' ELSE 'The cited source reports that ' || lower(left(t, 1)) || substr(t, 2) || {_NOTES} END AS revision FROM s""")
def proposed_revision(spark, d):
    return cases(spark, d).select("doc_id", R.proposed_revision(F.col("claim"), R.first_label(R.OUTCOME_TYPE, "disease_activity", text=F.col("t"))).alias("revision"))


@query("text_predicates", f"""WITH {CASES} SELECT doc_id, octet_length(encode(text)) <= 2000 AS fits, contains({COLLAPSE.format('text')}, left({COLLAPSE.format("CASE WHEN doc_id % 4 = 0 THEN upper(text) ELSE text END")}, 80)) AS anchored, source = 'src1' OR starts_with(source || '/x', 'src1/') OR source || '/x' = 'src2' OR starts_with(source || '/x', 'src2/') AS allowed,
contains(t, 'symptom') OR contains(t, 'inflam') AS mentions, CASE WHEN doc_id % 3 = 0 THEN true WHEN doc_id % 3 = 1 THEN true ELSE false END AS in_domain FROM k""")
def text_predicates(spark, d):
    t = F.col("text")
    asked = F.when(F.col("doc_id") % 3 == 1, "focus").when(F.col("doc_id") % 3 == 2, "other")
    return cases(spark, d).select(
        "doc_id", R.fits_cap(F.octet_length("text"), 2000).alias("fits"), R.anchored(F.when(F.col("doc_id") % 4 == 0, F.upper(t)).otherwise(t), t).alias("anchored"), R.under_path(F.concat("source", F.lit("/x")), ("src1", "src2")).alias("allowed"),
        R.contains_any(F.col("t"), ("symptom", "inflam")).alias("mentions"), R.in_domain(asked, "focus").alias("in_domain"),
    )


@query("model_validators", """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'high' ELSE 'low' END AS q, CASE WHEN doc_id % 3 = 0 THEN 'abstract_only' ELSE 'full_text' END AS access, CASE WHEN doc_id % 5 = 0 THEN 'expert_explanation' ELSE 'study' END AS level, CASE WHEN doc_id % 4 = 0 THEN 'high' ELSE 'moderate' END AS confidence, CASE WHEN doc_id % 11 = 0 THEN 'yes' END AS decision FROM documents)
SELECT doc_id, CASE WHEN access = 'abstract_only' AND q = 'high' THEN 'moderate' ELSE q END AS quality, concat_ws('; ', CASE WHEN level = 'expert_explanation' AND confidence = 'high' THEN 'confidence too high' END, CASE WHEN decision IS NOT NULL THEN 'review not blank' END) AS violations FROM r""")
def model_validators(spark, d):
    n = F.col("doc_id")
    rows = table(spark, d, "documents").select(
        "doc_id", F.when(n % 2 == 0, "high").otherwise("low").alias("quality"), F.when(n % 3 == 0, "abstract_only").otherwise("full_text").alias("access"), F.when(n % 5 == 0, "expert_explanation").otherwise("study").alias("level"),
        F.when(n % 4 == 0, "high").otherwise("moderate").alias("confidence"), F.when(n % 11 == 0, "yes").alias("decision"), F.lit("").alias("edited"), F.lit(None).cast("string").alias("notes"),
    )
    return R.reviewed(rows).select("doc_id", "quality", "violations")


QUESTIONS = (
    "Do I have UC?", "Will I have a flare next week?", "Should I stop taking my medication?", "Give me a diet plan", "Does my pain mean I am inflamed?", "What does the evidence say about fibre?", "Can you apply Crohn's evidence to ulcerative colitis?", "Is CRP useful?", "fibre AND (diet OR",
    "diet[ti] AND 2024/01/01[EDAT] : 2024/02/01[EDAT]", "diet AND ()", 'a "quoted term', "2024/01/01[EDAT] diet or", "",
)
_ASK = "[" + ", ".join("'" + q.replace("'", "''") + "'" for q in QUESTIONS) + "]"
ASKED = f"q AS (SELECT conv_id, turn, {_ASK}[(conv_id + turn) % {len(QUESTIONS)} + 1] || ' ' || text AS q FROM conversations), l AS (SELECT *, lower(q) AS t FROM q)"


def asked(spark, d):
    lead = F.get(F.array(*[F.lit(q) for q in QUESTIONS]), ((F.col("conv_id") + F.col("turn")) % len(QUESTIONS)).cast("int"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat(lead, F.lit(" "), "text").alias("q"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any(patterns, column: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, {_quoted(p)})" for p in patterns) + ")"


def _kinds(groups, column: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_any(p, column)} THEN '{k}' END" for k, p in groups.items()) + "], lambda v: v IS NOT NULL)"


FAMILY = f"CASE WHEN {' AND '.join(_any([p], 't') for p in field.MISAPPLIED)} THEN 'crohns_to_uc_misapplication' " + " ".join(f"WHEN {_any(p, 't')} THEN '{k}'" for k, p in field.BOUNDARIES.items()) + " ELSE 'none' END"
UNSUPPORTED = _has(field.UNSUPPORTED, "t")
_INTENT = "CASE family " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in field.INTENTS.items()) + " END"


@query("safety_families", f"WITH {ASKED}, f AS (SELECT conv_id, turn, {FAMILY} AS family, {UNSUPPORTED} AS unsupported FROM l) SELECT *, {_INTENT} AS intent FROM f")
def safety_families(spark, d):
    return asked(spark, d).select("conv_id", "turn", field.boundary(F.col("q")).alias("family"), field.unsupported(F.col("q")).alias("unsupported")).withColumn("intent", field.intent(F.col("family")))


@query("query_faults", rf"""WITH {ASKED} SELECT conv_id, turn, concat_ws('; ', CASE WHEN length(replace(q, '(', '')) <> length(replace(q, ')', '')) THEN 'unbalanced brackets' END, CASE WHEN (length(q) - length(replace(q, '"', ''))) % 2 <> 0 THEN 'odd quotes' END, CASE WHEN contains(t, '[ti]') OR contains(t, '[au]') OR contains(t, '[mesh:noexp]') THEN 'forbidden tag' END,
CASE WHEN (length(t) - length(replace(t, '[edat]', ''))) // 6 % 2 <> 0 THEN 'open range' END, CASE WHEN regexp_matches(t, '\(\s*\)|(?:and|or)\s*$') THEN 'empty clause' END) AS faults FROM l""")
def query_faults(spark, d):
    return asked(spark, d).select("conv_id", "turn", F.array_join(S.lint_faults(F.col("q")), "; ").alias("faults"))


@query("trial_disposition", """WITH r AS (SELECT doc_id, ['COMPLETED', 'RECRUITING', 'WITHDRAWN', 'TERMINATED', 'UNKNOWN'][doc_id % 5 + 1] AS s, ['trial', 'guideline', 'paper'][doc_id % 3 + 1] AS k, length(text) % 90 AS n FROM documents)
SELECT doc_id, CASE WHEN k = 'trial' AND s IN ('WITHDRAWN', 'UNKNOWN') THEN 'rejected: registry status' WHEN k = 'trial' AND s NOT IN ('COMPLETED', 'TERMINATED') THEN 'deferred: no results yet' WHEN k = 'guideline' AND n < 40 THEN 'deferred: no public passage' ELSE 'accepted' END AS disposition FROM r""")
def trial_disposition(spark, d):
    pick = lambda values, m: F.get(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % m).cast("int"))
    out = S.trial_disposition(pick(("COMPLETED", "RECRUITING", "WITHDRAWN", "TERMINATED", "UNKNOWN"), 5), pick(("trial", "guideline", "paper"), 3), F.length("text") % 90)
    return table(spark, d, "documents").select("doc_id", out.alias("disposition"))


@query("sanitised_titles", rf"SELECT doc_id, left({STRIP.format("replace(regexp_replace(" + TITLE + r" || '::x', '[\x00-\x1f\x7f]', ' ', 'g'), '::', ': :')")}, 300) AS title, lang || '; ' || source AS cell FROM documents")
def sanitised_titles(spark, d):
    return table(spark, d, "documents").select("doc_id", X.sanitise(F.concat(X.title_of(F.col("text")), F.lit("::x"))).alias("title"), X.render_cell(F.array("lang", "source")).alias("cell"))


_TOPIC_WORDS = tuple(w for words in field.TOPICS.values() for w in words)
_SCORE = f"CASE WHEN {_has(field.RESULTS, 'lower(x)')} THEN 5 ELSE 0 END + CASE WHEN {_has(_TOPIC_WORDS, 'lower(x)')} THEN 3 ELSE 0 END - CASE WHEN {_has(field.METHODS, 'lower(x)')} THEN 5 ELSE 0 END - CASE WHEN {_any([field.AIMS], 'lower(x)')} THEN 3 ELSE 0 END"
_LABEL = r"'^[A-Z][A-Z /&-]{2,}:\s*'"


@query("sentence_scores", rf"""WITH {CASES}, b AS (SELECT doc_id, string_split(regexp_replace({COLLAPSE.format(f"regexp_replace(claim, {_LABEL}, '')")}, '([.!?])\s+([A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS l FROM k),
s AS (SELECT doc_id, list_transform(list_filter(l, lambda x: length(x) BETWEEN 20 AND 700), lambda x: {_SCORE}) AS s FROM b) SELECT doc_id, len(s) AS n, coalesce(list_sum(s), 0)::BIGINT AS total, list_max(s) AS best FROM s""")
def sentence_scores(spark, d):
    rows = cases(spark, d).select("doc_id", F.transform(R.labelled_sentences(F.col("claim")), field.sentence_score).alias("s"))
    return rows.select("doc_id", F.size("s").cast("long").alias("n"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.array_max("s").alias("best"))


_REASON = "CASE " + " ".join(f"WHEN {_has(words, 't') if what == 'text' else 'ot IN (' + ', '.join(map(repr, words)) + ')' if what == 'outcome' else 'source = ' + repr(words[0])} THEN {_quoted(reason)}" for what, words, reason in field.REASONS[:-1]) + f" ELSE {_quoted(field.REASONS[-1][2])} END"


@query("field_labels", f"""WITH {CASES}, o AS (SELECT *, {sql_first_label(R.OUTCOME_TYPE, 'disease_activity', text='t')} AS ot FROM k), z AS (SELECT doc_id, list_filter([{", ".join(f"CASE WHEN {_has(w, 't')} THEN '{k}' END" for k, w in field.TOPICS.items())}], lambda v: v IS NOT NULL)[1:{field.MOST_TOPICS}] AS tp, {_kinds(field.CONTEXTS, 't')} AS cx,
CASE {" ".join(f"WHEN {_any([p], 't')} THEN {i}" for i, p in enumerate(field.EXCLUDED, 1))} ELSE 0 END AS excluded_by, md5({_REASON}) AS reason FROM o)
SELECT doc_id, coalesce(nullif(array_to_string(tp, ','), ''), '{field.NO_TOPIC}') AS topics, coalesce(nullif(array_to_string(cx, ','), ''), '{field.NO_CONTEXT}') AS contexts, excluded_by, reason FROM z""")
def field_labels(spark, d):
    rows = cases(spark, d).withColumn("ot", R.first_label(R.OUTCOME_TYPE, "disease_activity", text=F.col("t")))
    reason = field.revision_reason(F.col("claim"), F.col("ot"), F.col("source"))
    return rows.select("doc_id", F.array_join(field.topics(F.col("claim")), ",").alias("topics"), F.array_join(field.contexts(F.col("claim")), ",").alias("contexts"), field.excluded_by(F.col("claim")).alias("excluded_by"), F.md5(reason.cast("binary")).alias("reason"))


@query("labelled_sentences", rf"""WITH a AS (SELECT doc_id, regexp_replace(CASE WHEN doc_id % 2 = 0 THEN 'RESULTS: ' ELSE '' END || text, '^[A-Z][A-Z /&-]{{2,}}:\s*', '') AS text FROM documents), b AS (SELECT doc_id, string_split(regexp_replace({COLLAPSE.format('text')}, '([.!?])\s+([A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS l FROM a)
SELECT doc_id, len(list_filter(l, lambda x: length(x) BETWEEN 20 AND 700)) AS n, md5(array_to_string(list_filter(l, lambda x: length(x) BETWEEN 20 AND 700), '|')) AS digest FROM b""")
def labelled_sentences(spark, d):
    text = F.concat(F.when(F.col("doc_id") % 2 == 0, "RESULTS: ").otherwise(""), "text")
    rows = table(spark, d, "documents").select("doc_id", R.labelled_sentences(text).alias("s"))
    return rows.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(F.array_join("s", "|").cast("binary")).alias("digest"))


@query("publication_types", "SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1) THEN 'guideline' ELSE 'paper' END AS kind FROM documents")
def publication_types(spark, d):
    kinds = F.get(F.array(*[F.lit(x) for x in ("Practice Guideline", "Consensus Development Conference", "Journal Article", "Review")]), (F.col("doc_id") % 4).cast("int"))
    return table(spark, d, "documents").select("doc_id", R.publication_class(F.array(F.lit("Journal Article"), kinds)).alias("kind"))


_SET = lambda groups, default: f"coalesce(nullif(array_to_string({_kinds(groups, 't')}, ','), ''), '{default}')"


@query("set_conflicts", f"""WITH {CASES}, l(study, level, "group") AS (VALUES {_LEVELS}), s AS (SELECT k.*, {sql_first_label(R.STUDY, R.STUDY_DEFAULT, title='ti', types='ty')} AS study, list_filter([{", ".join(f"CASE WHEN {_has(w, 't')} THEN '{k}' END" for k, w in field.TOPICS.items())}], lambda v: v IS NOT NULL)[1] AS tp FROM k),
c AS (SELECT doc_id AS id, coalesce(tp, '{field.NO_TOPIC}') AS topic, {sql_all_labels(R.CONDITION, 'unclear', 't')} AS cond, {_SET(field.CONTEXTS, field.NO_CONTEXT)} AS ctx, {sql_first_label(R.OUTCOME_TYPE, 'disease_activity', text='t')} AS o, level FROM s JOIN l USING (study)),
p AS (SELECT a.id, b.id AS other, a.cond <> b.cond AS dc, a.ctx <> b.ctx AS dx, (a.o = 'symptoms' AND b.o = 'inflammation') OR (a.o = 'inflammation' AND b.o = 'symptoms') AS op, a.level <> b.level AS dl FROM c a JOIN c b ON a.topic = b.topic AND a.id <> b.id)
SELECT c.id, c.topic, count(*) FILTER (dc OR dx OR op) AS n_conflicts, count(*) FILTER (dc) AS n_condition, count(*) FILTER (dx) AS n_context, count(*) FILTER (op) AS n_opposed, count(*) FILTER (dl AND (dc OR dx OR op)) AS n_level, min(other) FILTER (dc OR dx OR op) AS partner FROM c LEFT JOIN p USING (id) GROUP BY c.id, c.topic""")
def set_conflicts(spark, d):
    rows = cases(spark, d).select(
        F.col("doc_id").alias("id"), F.get(field.topics(F.col("claim")), F.lit(0)).alias("topic"), R.all_labels(R.CONDITION, "unclear", F.col("t")).alias("conditions"), field.contexts(F.col("claim")).alias("contexts"),
        R.first_label(R.OUTCOME_TYPE, "disease_activity", text=F.col("t")).alias("outcome"), R.study(F.lower("title"), F.col("types"))["level"].alias("level"),
    )
    return aggregates.set_conflicts(rows)


NOTES = ("fine", "You have UC", "we talked about sleep", "You will flare soon; this is proven to cure", "guaranteed to work")
_NOTE = "[" + ", ".join(map(_quoted, NOTES)) + "]"


@query("nested_denylist", f"""WITH x AS (SELECT doc_id, {_NOTE}[doc_id % {len(NOTES)} + 1] AS note, coalesce(text, '') AS body FROM documents), y AS (SELECT doc_id, '$.outer.items[0].note' AS path, lower(note) AS t FROM x UNION ALL SELECT doc_id, '$.outer.body', lower(body || ' ' || note) FROM x UNION ALL SELECT doc_id, '$.keys.' || note || '~', lower(note) FROM x),
z AS (SELECT doc_id, path, {_kinds(field.DENIED, 't')} AS k FROM y) SELECT doc_id, path, array_to_string(k, ',') AS kinds FROM z WHERE len(k) > 0""")
def nested_denylist(spark, d):
    note = F.get(F.array(*[F.lit(x) for x in NOTES]), (F.col("doc_id") % len(NOTES)).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", note.alias("note"), F.concat(F.coalesce("text", F.lit("")), F.lit(" "), note).alias("body"))
    outer = F.struct(F.array(F.struct("note", F.lit(1).alias("n"))).alias("items"), "body")
    made = rows.select(F.col("doc_id").alias("id"), F.to_json(F.struct(outer.alias("outer"), F.map_from_arrays(F.array("note"), F.array(F.lit(1))).alias("keys"))).alias("json"))
    return nested.denied(made).select(F.col("id").alias("doc_id"), "path", F.array_join("kinds", ",").alias("kinds"))
