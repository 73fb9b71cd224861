r"""Rule tables of the field, evaluated by ``Lexicon`` expressions: questions that are refused, content that is not kept, topics, contexts.

Patterns are for lower-case text; ``.`` stops at ``\n`` only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import Lexicon, contains_any

# ---- fixed values ----

#: Families of questions that are refused, in order of precedence.
BOUNDARIES = {
    "crohns_to_uc_misapplication": (
        r"\bcrohn'?s.*(claim|evidence|study|finding).*(apply|use).*(\buc\b|ulcerative colitis)\b",
        r"\bapply .*crohn'?s.* to (\buc\b|ulcerative colitis)\b",
        r"\buse .*crohn'?s.* (evidence|claim|result).* for (\buc\b|ulcerative colitis)\b",
        r"\btreat .*crohn'?s.* evidence as.*(\buc\b|ulcerative colitis)\b",
    ),
    "diagnosis_request": (
        r"\bdo i have (uc|ulcerative colitis)\b",
        r"\bis this (a )?flare\b",
        r"\bam i (having|in) a flare\b",
        r"\bdiagnos\w*\s+me\b",
        r"\bcan you diagnos\w*\b",
        r"\bdo i have ibd\b",
        r"\bwhat('s| is) wrong with me\b",
    ),
    "flare_prediction": (
        r"\bwill i (have|get) a flare\b",
        r"\bpredict\w* .*(flare)\b",
        r"\bwhen will (my|i) flare\b",
        r"\bam i (going|about) to flare\b",
    ),
    "medication_change": (
        r"\bshould i (start|stop|change|increase|decrease|reduce) .*(medication|drug|biologic|steroid|mesalamine|azathioprine|infliximab|adalimumab|humira|remicade|prednisone)\b",
        r"\b(start|stop|change) my (medication|meds|dose|dosage)\b",
        r"\bwhat (medication|dose) should i (take|use)\b",
        r"\bincrease my dose\b",
        r"\bcan i stop taking\b",
    ),
    "individualized_diet_plan": (
        r"\bgive me a diet plan\b",
        r"\b(create|build|make|design) (me )?a (meal|diet|eating) plan\b",
        r"\bwhat should i eat (today|this week|for my)\b.*\bpersonal\b",
        r"\bpersonalized (diet|meal) plan\b",
        r"\bmy (specific|personal) diet plan\b",
        r"\bplan (my|out my) meals\b",
    ),
    "symptom_inflammation_equivalence": (
        r"\bdoes my pain mean i('?m| am) inflamed\b",
        r"\bdoes .*(pain|symptom).*(mean|indicate|prove).*(inflam)",
        r"\bif i have symptoms.*(does|is).*(inflam)",
        r"\bno symptoms.*(mean|means).*(no inflammation|not inflamed)\b",
    ),
}
#: One of each, anywhere, is the first family too.
MISAPPLIED = (r"\bcrohn'?s\b", r"\buc\b|\bulcerative colitis\b", r"\b(apply|use|treat|extend|generalize|carry over|transfer)\b")
#: The intent that a family stands for.
INTENTS = {
    "diagnosis_request": "diagnosis_seeking", "flare_prediction": "flare_prediction_seeking", "medication_change": "medication_change_seeking", "individualized_diet_plan": "diet_plan_seeking",
    "symptom_inflammation_equivalence": "symptom_inflammation_question", "crohns_to_uc_misapplication": "crohns_misapplication", "none": "question",
}
#: Subjects without evidence.
UNSUPPORTED = (
    "esr", "erythrocyte sedimentation rate", "biologic", "infliximab", "adalimumab", "vedolizumab", "ustekinumab", "jak inhibitor", "tofacitinib", "upadacitinib", "mucosal healing", "colonoscopy", "intestinal ultrasound", "bowel ultrasound",
    "crp", "c-reactive protein", "fecal calprotectin", "calprotectin",
)
#: Content that is not kept in a memory, by kind.
DENIED = {
    "diagnosis": (
        r"\byou have (uc|ulcerative colitis|ibd|crohn'?s)\b",
        r"\byour (uc|ulcerative colitis) is (active|in flare|flaring|severe|mild|moderate)\b",
        r"\bdiagnos(is|ed|es)\b.*\b(you|patient)\b",
        r"\byou are (having|in) a flare\b",
        r"\bconfirmed (diagnosis|flare)\b",
    ),
    "flare": (
        r"\byou will (have|get) a flare\b",
        r"\byou will flare\b",
        r"\byou('re| are) (going|about) to flare\b",
        r"\bflare (is|likely) (coming|imminent|predicted)\b",
    ),
    "treatment": (
        r"\byou should (start|stop|take|increase|decrease|reduce) .*(medication|drug|biologic|steroid|mesalamine|azathioprine|infliximab|adalimumab|prednisone|dose)\b",
        r"\brecommend(ed|s)? (starting|stopping|taking|increasing|decreasing) .*(medication|dose|drug)\b",
        r"\bprescri(be|bed|ption)\b",
    ),
    "unsupported": (
        r"\bclinically approved\b",
        r"\bproven to (cure|treat|fix)\b",
        r"\bguarantee(d|s)? to (cure|treat|work)\b",
        r"\bthis (cures|treats|fixes) (your|the) (uc|ulcerative colitis)\b",
    ),
}
#: Claims that are excluded.
EXCLUDED = (
    r"\b(cure[sd]?|reverse[sd]?|guarantee[sd]?)\b",
    r"\b(stop|discontinue|change)\b.{0,30}\b(medication|treatment|drug)\b",
    r"\bpredict(s|ed|ion)?\b.{0,20}\bflare\b",
    r"\b(food|meal)\b.{0,20}\bcaused?\b.{0,20}\b(flare|inflammation)\b",
    r"\bdetox\b|\bpunishment exercise\b|\bextreme fasting\b",
)
#: Topics and their words; at most ``MOST_TOPICS`` of a text count.
TOPICS = {
    "dietary_patterns": ("mediterranean", "dietary pattern", "whole food", "western diet", "specific carbohydrate"),
    "ultra_processed": ("ultra-processed", "processed food"),
    "fibre": ("fiber", "fibre", "low residue", "low-residue"),
    "dairy_lactose": ("dairy", "lactose", "milk"),
    "coffee_caffeine": ("coffee", "caffeine"),
    "alcohol": ("alcohol",),
    "red_processed_meat": ("red meat", "processed meat", "meat consumption"),
    "fruit_vegetables": ("fruit", "vegetable"),
    "probiotics_prebiotics": ("probiotic", "prebiotic"),
    "food_additives": ("additive", "emulsifier", "carrageenan", "maltodextrin"),
    "enteral_nutrition": ("enteral nutrition", "exclusion diet", "liquid formula"),
    "nutrition_status": ("malnutrition", "micronutrient", "deficien", "nutritional status"),
    "physical_activity": ("physical activity", "exercise"),
    "sleep": ("sleep",),
    "stress_quality_of_life": ("stress", "quality of life", "psychological"),
    "smoking": ("smoking", "tobacco"),
    "meal_timing_hydration_sodium": ("meal timing", "fasting", "hydration", "sodium"),
    "symptoms_vs_inflammation": ("symptom", "inflammation", "biomarker", "calprotectin"),
    "post_surgery": ("surgery", "perioperative", "postoperative"),
    "stricture_obstruction": ("stricture", "obstruction"),
}
NO_TOPIC, MOST_TOPICS = "core_condition_knowledge", 6
#: States of the disease that a text is about.
CONTEXTS = {
    "active_disease": (r"\b(active|induction)\b",),
    "remission": (r"\b(remission|maintenance|quiescent)\b",),
    "post_surgery": (r"\b(postoperative|post-operative|perioperative|surgery)\b",),
    "stricture_or_obstruction_risk": (r"\b(stricture|obstruction)\b",),
}
NO_CONTEXT = "general_or_unspecified"
#: Words (for aims: a pattern) that raise or lower a sentence's score.
RESULTS = ("conclu", "result", "associated", "improved", "reduced", "increased", "evidence", "recommend")
METHODS = ("we searched", "methods", "database", "registration")
AIMS = r"\bobjective\b|\baim\b"
#: Openings that are taken off a claim, one after the other; the last two as they are written.
OPENINGS = (
    r"(?i)^(RESULTS?|CONCLUSIONS?|BACKGROUND\s*&\s*AIMS|METHODS?):\s*",
    r"(?i)^BEST PRACTICE ADVICE \d+:\s*",
    r"(?i)^(Alcohol|Fruit and vegetables)\s+",
    r"^Melanie Living with Crohn's\s+",
    r"^10\s+",
)
#: Why a claim is reworded, by its words, outcome type or source; the last one for all others.
REASONS = (
    ("text", ("associated", "risk", "incidence"), "Keep the observational or incidence framing explicit; do not convert association into causal or individual disease-course advice."),
    ("text", ("recommended", "therapy", "treatment", "preferred", "should"), "Attribute the statement to the source and retain disease-state, population, evidence-strength, and clinician/dietitian context so it is not personalized treatment advice."),
    ("outcome", ("symptoms", "inflammation", "biomarkers", "disease_activity"), "State the measured outcome precisely and avoid treating symptom change, biomarkers, and inflammation as interchangeable."),
    ("source", ("expert",), "Remove webpage extraction artifacts and present the material as general education, not individualized diet advice."),
    ("", (), "Narrow the wording to the exact passage and retain the source's limitations and uncertainty."),
)

# ---- rules over them ----

_DOT = "(?d)"


def _lexicon(groups: dict[str, tuple[str, ...]], default: str) -> Lexicon:
    return Lexicon({k: tuple(_DOT + p for p in v) for k, v in groups.items()}, default, patterns=True)


def _plain(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def boundary(question: Column) -> Column:
    """The first family that refuses a question, else ``none``; a null question is empty."""
    t = _plain(question)
    misapplied = F.lit(True)
    for p in MISAPPLIED:
        misapplied = misapplied & t.rlike(p)
    return F.when(misapplied, next(iter(BOUNDARIES))).otherwise(_lexicon(BOUNDARIES, "none").first(t))


def intent(family: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in INTENTS.items() for x in kv]), family), F.lit("question"))


def unsupported(question: Column) -> Column:
    return contains_any(_plain(question), UNSUPPORTED)


def denied_kinds(text: Column) -> Column:
    """Kinds of content in a text that is not to be kept, in order."""
    return _lexicon(DENIED, "").all(_plain(text))


def excluded_by(text: Column) -> Column:
    """Number (from 1) of the first pattern that excludes a claim, 0 if none does."""
    return _lexicon({str(i): (p,) for i, p in enumerate(EXCLUDED, 1)}, "0").first(_plain(text)).cast("int")


def _once(text: Column, of) -> Column:
    """``of`` the lower-case text, which is made once and not again for each term."""
    return F.transform(F.array(_plain(text)), of)[0]


def topics(text: Column) -> Column:
    return _once(text, lambda t: Lexicon(TOPICS, NO_TOPIC).all(t, MOST_TOPICS))


def contexts(text: Column) -> Column:
    return _once(text, lambda t: _lexicon(CONTEXTS, NO_CONTEXT).all(t))


def sentence_score(sentence: Column) -> Column:
    """5 for a result word, 3 for a topic word, minus 5 for methods, minus 3 for aims."""
    t = _plain(sentence)
    worth = lambda hit, n: F.when(hit, n).otherwise(0)
    return worth(contains_any(t, RESULTS), 5) + worth(contains_any(t, tuple(w for words in TOPICS.values() for w in words)), 3) - worth(contains_any(t, METHODS), 5) - worth(t.rlike(AIMS), 3)


def clean_opening(claim: Column) -> Column:
    out = claim
    for p in OPENINGS:
        out = F.regexp_replace(out, p, "")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def revision_reason(claim: Column, outcome_type: Column, source_type: Column) -> Column:
    """Why a claim is reworded: the first reason whose words, outcome type or source it has."""
    t = _plain(claim)
    out = F.lit(REASONS[-1][2])
    for what, words, reason in reversed(REASONS[:-1]):
        hit = contains_any(t, words) if what == "text" else (outcome_type if what == "outcome" else source_type).isin(*words)
        out = F.when(F.coalesce(hit, F.lit(False)), reason).otherwise(out)
    return out
