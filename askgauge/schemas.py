"""Table layouts and the fixed vocabularies the tables use."""

from pyspark.sql import types as T

STRING_LIST = T.ArrayType(T.StringType())


def _struct(spec):
    return T.StructType([T.StructField(name, dtype) for name, dtype in spec])


S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.ByteType()

# --- Fixed values: vocabularies that appear in the data or in the result tables ---

QUESTION_TYPES = ("multiple", "boolean")
DIFFICULTY_LEVELS = {"easy": 1, "medium": 2, "hard": 3}
WRONG_ANSWERS_BY_TYPE = {"multiple": 3, "boolean": 1}
BOOLEAN_CHOICES = ("True", "False")
OPTION_LABELS = {"letters": ("A", "B", "C", "D"), "numbers": ("1", "2", "3", "4")}
LABEL_STYLES = ("letters", "numbers", "text")

CATEGORY_GROUP_RENAMES = {"Science & Nature": "Science"}
CATEGORY_NAME_RENAMES = {"Science & Nature": "Nature"}

# Upper bounds (billions of parameters, exclusive) with the class below each; the last has no bound.
SIZE_CLASSES = ((2.0, "très petit (< 2B)"), (5.0, "petit (2-5B)"), (None, "moyen (5B et plus)"))

RUN_DONE_BEFORE = "déjà terminée"
RUN_MODEL_MISSING = "modèle introuvable"
RUN_COMPLETE = "terminée"
RUN_INCOMPLETE = "incomplète"
TRIAL_OK, TRIAL_ERRORS, TRIAL_SILENT = "OK", "erreurs", "aucune réponse"

DIFFICULTY_LABELS = {"easy": "Facile", "medium": "Moyen", "hard": "Difficile", "all": "Toutes"}
QUESTION_TYPE_LABELS = {"multiple": "QCM", "boolean": "Vrai/Faux"}
FORMAT_LABELS = {"letters": "Lettres", "numbers": "Chiffres", "text": "Texte"}
PROMPT_LABELS = {
    "v1_letters": "Lettres (A–D)",
    "v2_numbers": "Chiffres (1–4)",
    "v3_text": "Texte de la réponse",
    "v4_letters_hot": "Lettres, température 1",
    "all": "Tous les prompts",
}

SMALL_SAMPLE = 30
SAMPLE_NOTE, SMALL_SAMPLE_NOTE = "n = ", "Échantillon faible : n = "
STATUS_SHARES = ("Juste", "Faux", "Format invalide")
KNOWLEDGE_MEASURES = {"accuracy": "Précision", "accuracy_when_valid": "Précision si format valide"}
TEMPERATURE_RUNS = {"accuracy_cold": "Température 0", "accuracy_hot": "Température 1"}
ANSWERS_LOST, ANSWERS_GAINED = "Perdues (juste → faux)", "Gagnées (faux → juste)"
POSITION_MEASURES = {"share_chosen": "Réponses du modèle", "share_expected": "Bonnes réponses réelles"}
NO_THINKING_SUFFIX = " /no_think"

MARTS = (
    "mart_leaderboard",
    "mart_model_profile",
    "mart_prompt_format",
    "mart_temperature_effect",
    "mart_perf_by_category",
    "mart_perf_by_difficulty",
    "mart_position_bias",
    "mart_question_insights",
)

# --- Fixed values: columns of the sources ---

RAW_QUESTIONS = _struct(
    [(c, S) for c in ("type", "difficulty", "category", "question", "correct_answer", "incorrect_answers")]
)

API_QUESTION = _struct(
    [(c, S) for c in ("type", "difficulty", "category", "question", "correct_answer")]
    + [("incorrect_answers", STRING_LIST)]
)
API_PAGE = _struct([("response_code", I), ("results", T.ArrayType(API_QUESTION))])

CLEAN_QUESTIONS = _struct(
    [
        ("question_id", S),
        ("type", S),
        ("difficulty", S),
        ("difficulty_level", B),
        ("category", S),
        ("category_group", S),
        ("category_name", S),
        ("question", S),
        ("correct_answer", S),
        ("incorrect_answers", STRING_LIST),
        ("nb_options", B),
    ]
)

RUN_CONFIG = _struct(
    [("run_order", I)]
    + [(c, S) for c in ("run_id", "model_key", "lmstudio_id", "model_name", "publisher", "country")]
    + [("params_b", D)]
    + [
        (c, S)
        for c in (
            "disable_thinking",
            "prompt_version",
            "label_style",
            "prompt_description",
            "system_prompt",
            "user_template",
        )
    ]
    + [("temperature", D), ("max_tokens", I), ("n_questions", I), ("sample_seed", I)]
)

PROMPT_SET = _struct([(c, S) for c in ("prompt_version", "system_prompt", "user_template", "structured_output")])

RESPONSES = _struct(
    [
        ("run_id", S),
        ("run_order", I),
        ("model_key", S),
        ("lmstudio_id", S),
        ("model_name", S),
        ("publisher", S),
        ("country", S),
        ("params_b", D),
        ("prompt_version", S),
        ("label_style", S),
        ("temperature", D),
        ("max_tokens", I),
        ("sample_seed", I),
        ("sample_rank", I),
        ("question_id", S),
        ("type", S),
        ("difficulty", S),
        ("category_group", S),
        ("category_name", S),
        ("question", S),
        ("choices", STRING_LIST),
        ("correct_answer", S),
        ("correct_label", S),
        ("system_prompt", S),
        ("user_prompt", S),
        ("raw_response", S),
        ("response_time", D),
        ("prompt_tokens", I),
        ("completion_tokens", I),
        ("time_to_first_token", D),
        ("stop_reason", S),
        ("created_at", S),
    ]
)

# --- Fixed values: column orders of the silver tables ---

GRADED_COLUMNS = (
    "run_id",
    "run_order",
    "model_key",
    "lmstudio_id",
    "model_name",
    "model_publisher",
    "model_country",
    "model_params_b",
    "prompt_version",
    "label_style",
    "temperature",
    "max_tokens",
    "sample_seed",
    "sample_rank",
    "question_id",
    "choices",
    "correct_answer",
    "correct_label",
    "correct_position",
    "raw_response",
    "clean_response",
    "ai_position",
    "ai_label",
    "ai_answer",
    "is_valid_format",
    "ai_correct",
    "answer_status",
    "response_time_s",
    "time_to_first_token_s",
    "prompt_tokens",
    "completion_tokens",
    "stop_reason",
    "is_truncated",
    "created_at",
)

ENRICHED_COLUMNS = (
    "run_id",
    "model_key",
    "model_name",
    "model_publisher",
    "model_country",
    "model_params_b",
    "prompt_version",
    "label_style",
    "temperature",
    "question_id",
    "sample_rank",
    "question_type",
    "difficulty",
    "difficulty_level",
    "category",
    "category_group",
    "category_name",
    "question_text",
    "nb_options",
    "random_baseline",
    "choices",
    "correct_answer",
    "correct_position",
    "raw_response",
    "ai_position",
    "ai_answer",
    "is_valid_format",
    "ai_correct",
    "answer_status",
    "response_time_s",
    "time_to_first_token_s",
    "prompt_tokens",
    "completion_tokens",
    "stop_reason",
    "is_truncated",
    "created_at",
)
