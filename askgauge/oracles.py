"""The same results in DuckDB SQL, for checking every query on the same tables.

Each building block is a common table expression; ``oracle(sql, *blocks)`` prepends the blocks a
statement needs, together with the blocks those rest on.
"""

# What Python's str.split() separates on, as a character class for DuckDB's patterns.
PYTHON_SPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# name -> (SQL, names of the blocks it reads)
BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {}


def block(name, sql, *needs):
    BLOCKS[name] = (sql, needs)


def oracle(sql, *blocks):
    ordered = []

    def visit(name):
        if name not in ordered:
            for needed in BLOCKS[name][1]:
                visit(needed)
            ordered.append(name)

    for name in blocks:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n][0]})" for n in ordered) + "\n" + sql


# --- Expression helpers ---


def rnd(value, digits=4):
    """Rounded value; adding zero turns a negative zero into zero."""
    return f"(round(({value})::DOUBLE, {digits}) + 0.0)"


def div(a, b):
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def wilson(k, n, sign):
    p, z2 = div(k, n), "(1.96::DOUBLE * 1.96::DOUBLE)"
    half = f"1.96::DOUBLE * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n}::DOUBLE * {n}))"
    return f"(({p} + {z2} / (2 * {n}::DOUBLE) {sign} {half}) / (1 + {z2} / {n}::DOUBLE))"


def ci(k, n):
    return f"{rnd(wilson(k, n, '-'))} AS accuracy_ci_low, {rnd(wilson(k, n, '+'))} AS accuracy_ci_high"


def chance(acc, base):
    return f"(({acc} - {base}) / (1 - {base}))"


def strip(x):
    return f"trim({x}, E' \\t\\n\\f\\r')"


def norm(x):
    quoted = f"trim({strip(x)}, E'\"''`*')"
    return f"lower(regexp_replace({strip(f'rtrim({strip(quoted)}, {chr(39)}.!{chr(39)})')}, '\\s+', ' ', 'g'))"


def labels(column, mapping):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {column} END"


# --- Questions and runs ---

block(
    "q0",
    """SELECT p_partkey AS seq,
  CASE WHEN p_size % 6 = 0 THEN 'boolean' ELSE 'multiple' END AS type,
  (['easy','medium','hard'])[p_partkey % 3 + 1] AS difficulty,
  CASE WHEN p_size < 25 THEN 'Entertainment: ' || p_type WHEN p_type = 'PROMO' THEN 'Science & Nature'
    ELSE p_type END AS category,
  'Which brand makes ' || p_name || ' no. ' || p_partkey || '?' AS question,
  CASE WHEN p_size % 6 <> 0 THEN p_brand WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END AS correct_answer,
  CASE WHEN p_size % 6 <> 0 THEN [concat('Brand#', (substr(p_brand, 7)::INT + s) % 25 + 1) FOR s IN [6, 12, 18]]
    WHEN p_partkey % 2 = 0 THEN ['False'] ELSE ['True'] END AS incorrect_answers
FROM part""",
)


def attributes(source):
    return f"""SELECT * EXCLUDE (grp, nam),
  CASE grp WHEN 'Science & Nature' THEN 'Science' ELSE grp END AS category_group,
  CASE nam WHEN 'Science & Nature' THEN 'Nature' ELSE nam END AS category_name
FROM (SELECT *, trim(string_split(category, ':')[1]) AS grp, trim(string_split(category, ':')[-1]) AS nam,
  (CASE difficulty WHEN 'easy' THEN 1 WHEN 'medium' THEN 2 WHEN 'hard' THEN 3 END)::TINYINT AS difficulty_level,
  (len(incorrect_answers) + 1)::TINYINT AS nb_options,
  left(md5(lower(question) || '||' || lower(correct_answer)), 12) AS question_id FROM {source})"""


block("q", attributes("q0"), "q0")
block(
    "stq",
    """SELECT question_id, type AS question_type, difficulty, difficulty_level, category, category_group,
  category_name, question AS question_text, correct_answer, incorrect_answers, nb_options FROM q""",
    "q",
)
block(
    "runs",
    r"""SELECT (m * 4 + p + 1)::INT AS run_order, concat('m', m, '__', ver) AS run_id, concat('m', m) AS model_key,
  concat('lab/model-', m) AS lmstudio_id, concat('Model ', m) AS model_name, concat('Lab ', m % 3) AS publisher,
  (['US','US','CN','FR'])[m + 1] AS country, ([1.0, 1.2, 3.0, 8.0])[m + 1]::DOUBLE AS params_b,
  CASE m WHEN 2 THEN 'true' ELSE 'false' END AS disable_thinking, ver AS prompt_version, sty AS label_style,
  concat('Answer by ', sty) AS prompt_description, concat('Reply with ', sty, ' only.') AS system_prompt,
  E'Question: {question}\n{options}\nAnswer:' AS user_template,
  CASE p WHEN 3 THEN 1 ELSE 0 END::DOUBLE AS temperature, CASE p WHEN 2 THEN 40 ELSE 5 END AS max_tokens,
  1000 AS n_questions, (42 + m // 2)::INT AS sample_seed
FROM (SELECT *, (['v1_letters','v2_numbers','v3_text','v4_letters_hot'])[p + 1] AS ver,
        (['letters','numbers','text','letters'])[p + 1] AS sty
  FROM (SELECT DISTINCT l_suppkey % 4 AS m, l_linenumber % 4 AS p FROM lineitem))""",
)


# --- Options and prompts ---


def choices(prefix=""):
    c = prefix
    return f"""CASE {c}type WHEN 'boolean' THEN ['True', 'False'] ELSE
    list_transform(list_sort(list_transform([{c}correct_answer] || {c}incorrect_answers,
      lambda o: {{'k': md5({c}question_id || '|' || o), 'o': o}})), lambda z: z.o) END"""


OPTIONS = r"""CASE label_style WHEN 'text' THEN array_to_string(list_transform(choices, lambda c: '- ' || c), E'\n')
  ELSE array_to_string(list_transform(list_zip(
    CASE label_style WHEN 'letters' THEN ['A','B','C','D'] ELSE ['1','2','3','4'] END[1:len(choices)], choices),
    lambda z: z[1] || '. ' || z[2]), E'\n') END"""
# The template is built around the two texts, so that braces inside them stay as they are.
USER_PROMPT = rf"""'Question: ' || question || E'\n' || {OPTIONS} || E'\nAnswer:'"""
SYSTEM_PROMPT = "system_prompt || CASE WHEN disable_thinking = 'true' THEN ' /no_think' ELSE '' END"
CORRECT_LABEL = """CASE label_style WHEN 'text' THEN choices[list_position(choices, correct_answer)]
  WHEN 'letters' THEN (['A','B','C','D'])[list_position(choices, correct_answer)]
  ELSE (['1','2','3','4'])[list_position(choices, correct_answer)] END"""

# --- Responses ---

block(
    "resp",
    rf"""SELECT run_id || CASE WHEN place > 1 THEN '__a' || place ELSE '' END AS run_id, run_order, model_key, lmstudio_id, model_name, publisher, country, params_b, prompt_version,
  label_style, temperature, max_tokens, sample_seed, seq::INT AS sample_rank, question_id, type, difficulty,
  category_group, category_name, question, choices, correct_answer, {CORRECT_LABEL} AS correct_label,
  {SYSTEM_PROMPT} AS system_prompt, {USER_PROMPT} AS user_prompt,
  CASE w WHEN 0 THEN tok WHEN 1 THEN '(' || tok || ')' WHEN 2 THEN lower(tok) || '.' WHEN 3 THEN 'Answer: ' || tok
    WHEN 4 THEN E'<think>because\nx</think>\n' || tok
    WHEN 5 THEN tok || CASE label_style WHEN 'text' THEN E'\nnote' ELSE '. ' || choices[pick] END
    WHEN 6 THEN tok || '. Nothing' WHEN 7 THEN 'The answer is ' || tok WHEN 8 THEN ''
    WHEN 9 THEN '*' || upper(choices[pick]) || '*.' WHEN 10 THEN 'RÉPONSE - ' || tok
    ELSE 'x_REASONING_END_0a__' || tok || E'\n' END AS raw_response,
  response_time, l_quantity::INT + 40 AS prompt_tokens, l_quantity::INT AS completion_tokens,
  response_time / 4 AS time_to_first_token,
  CASE l_returnflag WHEN 'A' THEN 'eosFound' WHEN 'N' THEN 'maxPredictedTokensReached' END AS stop_reason,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS created_at
FROM (SELECT *, CASE label_style WHEN 'letters' THEN 'ABCD'[pick] WHEN 'numbers' THEN pick::VARCHAR
        ELSE choices[pick] END AS tok
  FROM (SELECT *, (l_orderkey % 997 + 3)::DOUBLE / 1000 AS response_time,
          CASE WHEN l_partkey % 11 = 0 THEN 0 ELSE l_quantity::INT % 12 END AS w,
          CASE WHEN l_partkey % 11 = 0 OR (l_partkey % 9 <> 0 AND l_orderkey % 10 < 3 + 2 * m)
                 THEN list_position(choices, correct_answer)
               WHEN l_partkey % 9 = 0 THEN list_position(choices, correct_answer) % len(choices) + 1
               ELSE 1 + (l_orderkey + l_linenumber) % len(choices) END AS pick
    FROM (SELECT l.*, runs.*, q.*, {choices('q.')} AS choices
      FROM (SELECT *, l_suppkey % 4 AS m, l_linenumber % 4 AS p, row_number() OVER (
              PARTITION BY l_suppkey % 4, l_linenumber % 4, l_partkey
              ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_returnflag, l_shipdate
            ) AS place FROM lineitem) l
      JOIN runs ON runs.run_order = l.m * 4 + l.p + 1 JOIN q ON q.seq = l.l_partkey)))""",
    "q",
    "runs",
)
block(
    "str",
    """SELECT * EXCLUDE (type, difficulty, category_group, category_name, question, publisher, country, params_b,
    response_time, time_to_first_token, created_at),
  publisher AS model_publisher, country AS model_country, params_b AS model_params_b,
  response_time AS response_time_s, time_to_first_token AS time_to_first_token_s,
  created_at::TIMESTAMP AS created_at FROM resp""",
    "resp",
)

# --- Grades ---


def graded(source):
    return rf"""SELECT * EXCLUDE (lab, first, rest, slot, system_prompt, user_prompt),
  CASE label_style WHEN 'text' THEN choices[ai_position] ELSE lab[ai_position] END AS ai_label,
  choices[ai_position] AS ai_answer, ai_position IS NOT NULL AS is_valid_format,
  coalesce(choices[ai_position] = correct_answer, false) AS ai_correct,
  CASE WHEN ai_position IS NULL THEN 'invalid_format' WHEN choices[ai_position] = correct_answer THEN 'correct'
    ELSE 'incorrect' END AS answer_status,
  lower(stop_reason) LIKE '%maxpredictedtokens%' AS is_truncated
FROM (SELECT *, list_position(choices, correct_answer) AS correct_position,
    CASE WHEN clean_response = '' THEN NULL
      WHEN label_style = 'text' THEN list_position(list_transform(choices, lambda c: {norm('c')}),
        {norm("regexp_extract(clean_response, '^([^' || chr(13) || chr(10) || ']*)', 1)")})
      WHEN rest = '' OR {norm('rest')} = {norm('choices[slot]')} THEN slot END AS ai_position
  FROM (SELECT *, list_position(lab, first) AS slot,
      {strip("regexp_replace(clean_response, '^[^ \\t\\n\\f\\r]+', '')")} AS rest
    FROM (SELECT *, CASE label_style WHEN 'letters' THEN ['A','B','C','D'][1:len(choices)]
          WHEN 'numbers' THEN ['1','2','3','4'][1:len(choices)] END AS lab,
        upper(regexp_extract(regexp_extract(clean_response, '^[^ \t\n\f\r]+'),
          '^\(?([A-Da-d1-4])[).:]?$', 1)) AS first
      FROM (SELECT *, {strip(r"regexp_replace(regexp_replace(regexp_replace(raw_response, '(?s)<think>.*?</think>', '', 'g'), '(?s)^.*_REASONING_END_[0-9a-f]+__', ''), '(?i)^\s*(answer|réponse)\s*[:\-]\s*', '')")} AS clean_response
        FROM {source}))))"""


block("graded", graded("str"), "str")
block(
    "enr",
    """SELECT g.run_id, g.model_key, g.model_name, g.model_publisher, g.model_country, g.model_params_b,
  g.prompt_version, g.label_style, g.temperature, g.question_id, g.sample_rank, s.question_type, s.difficulty,
  s.difficulty_level, s.category, s.category_group, s.category_name, s.question_text, s.nb_options,
  1::DOUBLE / s.nb_options AS random_baseline, g.choices, g.correct_answer, g.correct_position, g.raw_response,
  g.ai_position, g.ai_answer, g.is_valid_format, g.ai_correct, g.answer_status, g.response_time_s,
  g.time_to_first_token_s, g.prompt_tokens, g.completion_tokens, g.stop_reason, g.is_truncated, g.created_at
FROM graded g JOIN stq s USING (question_id)""",
    "graded",
    "stq",
)

# --- Evaluation tables ---

ACC = "avg(ai_correct::INT)"
RIGHT = "sum(ai_correct::INT)"

block(
    "mart_leaderboard",
    f"""SELECT model_key, model_name, model_publisher, model_country, model_params_b, prompt_version, label_style,
  temperature, temperature > 0 AS is_temperature_variant, n AS n_questions, k AS n_correct,
  {rnd(div('k', 'n'))} AS accuracy, {ci('k', 'n')}, {rnd('base')} AS random_baseline,
  {rnd(chance(div('k', 'n'), 'base'))} AS chance_corrected_score, {rnd(div('v', 'n'))} AS valid_format_rate,
  {rnd(div('k', 'v'))} AS accuracy_when_valid, {rnd(div('t', 'n'))} AS truncated_rate,
  {rnd('mean_s')} AS avg_response_time_s, {rnd('round(p95, 9)')} AS p95_response_time_s, {rnd('tok', 2)} AS avg_completion_tokens,
  {rnd(div('k', 'sum_s / 60'), 1)} AS correct_per_minute, rank() OVER (ORDER BY k::DOUBLE / n DESC) AS accuracy_rank
FROM (SELECT model_key, model_name, model_publisher, model_country, model_params_b, prompt_version, label_style,
    temperature, count(*) AS n, {RIGHT}::BIGINT AS k, count_if(is_valid_format)::BIGINT AS v, count_if(is_truncated)::BIGINT AS t,
    avg(random_baseline) AS base, avg(response_time_s) AS mean_s, sum(response_time_s) AS sum_s,
    quantile_cont(response_time_s, 0.95) AS p95, avg(completion_tokens) AS tok
  FROM enr GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)""",
    "enr",
)
block(
    "mart_model_profile",
    f"""SELECT a.model_key, model_name, model_publisher, model_country, model_params_b,
  CASE WHEN model_params_b < 2 THEN 'très petit (< 2B)' WHEN model_params_b < 5 THEN 'petit (2-5B)'
    ELSE 'moyen (5B et plus)' END AS size_class, n AS n_responses, {rnd(div('k', 'n'))} AS accuracy, {ci('k', 'n')},
  {rnd(chance(div('k', 'n'), 'base'))} AS chance_corrected_score, {rnd(div('v', 'n'))} AS valid_format_rate,
  {rnd(div('k', 'v'))} AS accuracy_when_valid, best_prompt, {rnd('hi')} AS best_prompt_accuracy, worst_prompt,
  {rnd('lo')} AS worst_prompt_accuracy, {rnd('hi - lo')} AS prompt_spread, {rnd('mean_s')} AS avg_response_time_s,
  {rnd(div('k', 'sum_s / 60'), 1)} AS correct_per_minute, rank() OVER (ORDER BY k::DOUBLE / n DESC) AS accuracy_rank
FROM (SELECT model_key, model_name, model_publisher, model_country, model_params_b, count(*) AS n,
    {RIGHT}::BIGINT AS k, count_if(is_valid_format)::BIGINT AS v, avg(random_baseline) AS base,
    avg(response_time_s) AS mean_s, sum(response_time_s) AS sum_s
  FROM enr WHERE temperature = 0 GROUP BY 1, 2, 3, 4, 5) a
JOIN (SELECT model_key, max(acc) AS hi, min(acc) AS lo, arg_min(prompt_version, row(-acc, prompt_version)) AS best_prompt,
    arg_min(prompt_version, row(acc, prompt_version)) AS worst_prompt
  FROM (SELECT model_key, prompt_version, {ACC} AS acc FROM enr WHERE temperature = 0 GROUP BY 1, 2)
  GROUP BY 1) b ON a.model_key = b.model_key""",
    "enr",
)
block(
    "fmt0",
    f"""SELECT model_key, model_name, model_params_b, prompt_version, label_style, count(*) AS n, {ACC} AS acc,
  avg(is_valid_format::INT) AS val, avg(ai_correct::INT) FILTER (is_valid_format) AS accv,
  avg(is_truncated::INT) AS tru, avg(completion_tokens) AS tok, avg(response_time_s) AS sec
FROM enr WHERE temperature = 0 GROUP BY 1, 2, 3, 4, 5""",
    "enr",
)
block(
    "mart_prompt_format",
    f"""SELECT f.model_key, f.model_name, f.model_params_b, f.prompt_version, f.label_style, f.n AS n_questions,
  {rnd('f.acc')} AS accuracy, {rnd('f.val')} AS valid_format_rate, {rnd('f.accv')} AS accuracy_when_valid,
  {rnd('f.acc - l.acc')} AS accuracy_delta_vs_letters, {rnd('f.val - l.val')} AS valid_format_delta_vs_letters,
  {rnd('f.tru')} AS truncated_rate, {rnd('f.tok', 2)} AS avg_completion_tokens, {rnd('f.sec')} AS avg_response_time_s,
  rank() OVER (PARTITION BY f.model_key ORDER BY f.acc DESC) AS rank_within_model
FROM fmt0 f LEFT JOIN fmt0 l ON l.label_style = 'letters' AND l.model_key = f.model_key""",
    "fmt0",
)
block(
    "mart_temperature_effect",
    f"""SELECT model_key, model_name, model_params_b, coalesce(difficulty, 'all') AS difficulty,
  coalesce(difficulty_level::INT, 0) AS difficulty_level, min(tc) AS temperature_cold, min(th) AS temperature_hot,
  count(*) AS n_questions, {rnd('avg(cc)')} AS accuracy_cold, {rnd('avg(ch)')} AS accuracy_hot,
  {rnd('avg(ch) - avg(cc)')} AS accuracy_delta, {rnd('avg(vc)')} AS valid_format_rate_cold,
  {rnd('avg(vh)')} AS valid_format_rate_hot, {rnd('avg(same)')} AS answer_stability,
  {rnd('avg(cc * (1 - ch))')} AS rate_correct_to_wrong, {rnd('avg((1 - cc) * ch)')} AS rate_wrong_to_correct
FROM (SELECT c.model_key, c.model_name, c.model_params_b, c.difficulty, c.difficulty_level, c.temperature AS tc,
    h.temperature AS th, c.ai_correct::INT AS cc, h.ai_correct::INT AS ch, c.is_valid_format::INT AS vc,
    h.is_valid_format::INT AS vh, (c.ai_position IS NOT DISTINCT FROM h.ai_position)::INT AS same
  FROM enr c JOIN enr h USING (model_key, question_id)
  WHERE c.label_style = 'letters' AND h.label_style = 'letters' AND c.temperature = 0 AND h.temperature > 0)
GROUP BY GROUPING SETS ((model_key, model_name, model_params_b, difficulty, difficulty_level),
  (model_key, model_name, model_params_b))""",
    "enr",
)
block(
    "mart_perf_by_category",
    f"""SELECT a.model_key, model_name, model_country, a.prompt_version, temperature, a.category_group,
  a.category_name, n AS n_questions, k AS n_correct, {rnd(div('k', 'n'))} AS accuracy, {ci('k', 'n')},
  {rnd('own')} AS model_accuracy, {rnd(div('k', 'n') + ' - own')} AS delta_vs_model_average,
  {rnd('everyone')} AS category_accuracy_all_models, rank() OVER w AS rank_in_category,
  rank() OVER w = 1 AS is_best_in_category
FROM (SELECT model_key, model_name, model_country, prompt_version, temperature, category_group, category_name,
    count(*) AS n, {RIGHT}::BIGINT AS k FROM enr GROUP BY 1, 2, 3, 4, 5, 6, 7) a
JOIN (SELECT model_key, prompt_version, {ACC} AS own FROM enr GROUP BY 1, 2) b
  ON a.model_key = b.model_key AND a.prompt_version = b.prompt_version
JOIN (SELECT prompt_version, category_group, category_name, {ACC} AS everyone FROM enr GROUP BY 1, 2, 3) c
  ON a.prompt_version = c.prompt_version AND a.category_group = c.category_group AND a.category_name = c.category_name
WINDOW w AS (PARTITION BY a.prompt_version, a.category_group, a.category_name ORDER BY k::DOUBLE / n DESC)""",
    "enr",
)
block(
    "mart_perf_by_difficulty",
    f"""SELECT * EXCLUDE (n, k, base, val), n AS n_questions, k AS n_correct, {rnd(div('k', 'n'))} AS accuracy,
  {ci('k', 'n')}, {rnd('base')} AS random_baseline, {rnd(chance(div('k', 'n'), 'base'))} AS chance_corrected_score,
  {rnd('val')} AS valid_format_rate
FROM (SELECT model_key, model_name, model_params_b, prompt_version, temperature, difficulty, difficulty_level,
    question_type, count(*) AS n, {RIGHT}::BIGINT AS k, avg(random_baseline) AS base, avg(is_valid_format::INT) AS val
  FROM enr GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)""",
    "enr",
)
block(
    "mart_position_bias",
    f"""SELECT e.model_key, e.model_name, e.prompt_version, e.label_style, e.temperature, e.question_type,
  e.position, CASE WHEN e.question_type <> 'boolean' THEN chr((64 + e.position)::INT)
    WHEN e.position = 1 THEN 'True' ELSE 'False' END AS position_label, coalesce(c.n, 0) AS n_chosen,
  e.n AS n_correct_here, {rnd(div('coalesce(c.n, 0)', 't.v'))} AS share_chosen, {rnd(div('e.n', 't.n'))} AS share_expected,
  {rnd(div('coalesce(c.n, 0)', 't.v') + ' - ' + div('e.n', 't.n'))} AS position_bias,
  {rnd(div('e.k', 'e.n'))} AS accuracy_when_correct_here
FROM (SELECT model_key, model_name, prompt_version, label_style, temperature, question_type,
    correct_position AS position, count(*) AS n, {RIGHT} AS k FROM enr GROUP BY 1, 2, 3, 4, 5, 6, 7) e
JOIN (SELECT model_key, prompt_version, question_type, count(*) AS n, count_if(is_valid_format) AS v
  FROM enr GROUP BY 1, 2, 3) t USING (model_key, prompt_version, question_type)
LEFT JOIN (SELECT model_key, prompt_version, question_type, ai_position AS position, count(*) AS n
  FROM enr WHERE is_valid_format GROUP BY 1, 2, 3, 4) c USING (model_key, prompt_version, question_type, position)""",
    "enr",
)
block(
    "votes",
    """SELECT question_id, ai_answer, ai_answer = correct_answer AS good, count(*) AS n
FROM enr WHERE temperature = 0 AND is_valid_format GROUP BY 1, 2, 3""",
    "enr",
)
block(
    "mart_question_insights",
    f"""SELECT question_id, question_text, question_type, difficulty, difficulty_level, category_group, category_name,
  correct_answer, n_models, n AS n_answers, k AS n_correct, {rnd(div('k', 'n'))} AS success_rate,
  CASE WHEN 3 * k >= 2 * n THEN 'easy' WHEN 3 * k >= n THEN 'medium' ELSE 'hard' END AS ai_difficulty,
  CASE WHEN 3 * k >= 2 * n THEN 1 WHEN 3 * k >= n THEN 2 ELSE 3 END AS ai_difficulty_level,
  n_models_correct_once, majority_answer, majority_votes,
  coalesce(majority_answer = correct_answer, false) AS is_majority_correct, top_wrong_answer,
  coalesce(wrong_votes, 0) AS top_wrong_votes, k = 0 AS is_all_wrong, k = n AS is_all_correct,
  k = 0 AND coalesce(wrong_votes, 0) * 2 >= n AS is_common_trap
FROM (SELECT question_id, any_value(question_text) AS question_text, any_value(question_type) AS question_type,
    any_value(difficulty) AS difficulty, any_value(difficulty_level) AS difficulty_level,
    any_value(category_group) AS category_group, any_value(category_name) AS category_name,
    any_value(correct_answer) AS correct_answer, count(DISTINCT model_key) AS n_models, count(*) AS n,
    {RIGHT}::BIGINT AS k, count(DISTINCT model_key) FILTER (ai_correct) AS n_models_correct_once
  FROM enr WHERE temperature = 0 GROUP BY 1)
LEFT JOIN (SELECT question_id, arg_min(ai_answer, row(-n, ai_answer)) AS majority_answer, max(n) AS majority_votes,
    arg_min(ai_answer, row(-n, ai_answer)) FILTER (NOT good) AS top_wrong_answer, max(n) FILTER (NOT good) AS wrong_votes
  FROM votes GROUP BY 1) USING (question_id)""",
    "enr",
    "votes",
)

# --- Contracts and cleaning ---


def report_sql(stage, checks, source):
    """One row per check: how many rows fail its condition."""
    return "\nUNION ALL ".join(
        f"""SELECT '{stage}' AS stage, '{name}' AS "check", n AS n_violations, n = 0 AS ok
FROM (SELECT {count}::BIGINT AS n FROM {source})"""
        for name, count in checks.items()
    )


def fails(ok):
    return f"count_if(NOT coalesce({ok}, false))"


block(
    "faulty_raw",
    """SELECT CASE WHEN seq % 101 = 0 THEN 'open' ELSE type END AS type,
  CASE WHEN seq % 103 = 0 THEN 'extreme' ELSE difficulty END AS difficulty,
  CASE WHEN seq % 107 = 0 THEN '' ELSE category END AS category, question,
  CASE WHEN type = 'boolean' AND seq % 127 = 0 THEN 'Maybe' ELSE correct_answer END AS correct_answer,
  CASE WHEN seq % 109 <> 0 THEN CASE WHEN seq % 113 = 0 THEN incorrect_answers[1:2] ELSE incorrect_answers END
    END AS parsed FROM q0""",
    "q0",
)
RAW_CONDITIONS = {
    "no_blank_value": "category <> '' AND question <> '' AND correct_answer <> ''",
    "known_type": "type IN ('multiple', 'boolean')",
    "known_difficulty": "difficulty IN ('easy', 'medium', 'hard')",
    "wrong_answers_are_a_list": "parsed IS NOT NULL",
    "multiple_has_three_wrong": "type <> 'multiple' OR len(parsed) = 3",
    "boolean_has_one_wrong": "type <> 'boolean' OR len(parsed) = 1",
    "boolean_answer_is_true_or_false": "type <> 'boolean' OR correct_answer IN ('True', 'False')",
}
FAILED_CHECKS = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{name}' END" for name, ok in RAW_CONDITIONS.items())
)
RAW_CHECKS = {"expected_columns": "min(0)"} | {name: fails(ok) for name, ok in RAW_CONDITIONS.items()}
block(
    "faulty_clean",
    """SELECT * EXCLUDE (question_id, question, correct_answer, incorrect_answers),
  CASE WHEN seq % 131 = 0 THEN repeat('0', 12) ELSE question_id END AS question_id,
  question || CASE WHEN seq % 137 = 0 THEN ' ' WHEN seq % 139 = 0 THEN ' &amp; more' ELSE '' END AS question,
  CASE WHEN seq % 149 = 0 THEN '' WHEN seq % 151 = 0 THEN incorrect_answers[1] ELSE correct_answer END AS correct_answer,
  incorrect_answers || CASE WHEN seq % 157 = 0 THEN [upper(incorrect_answers[1])] ELSE [] END AS incorrect_answers
FROM q""",
    "q",
)


def no_text(condition):
    """No text column and no wrong answer meets the condition on x."""
    texts = "[category, question, correct_answer] || incorrect_answers"
    return fails(f"len(list_filter({texts}, lambda x: {condition})) = 0")


CLEAN_CHECKS = {
    "question_id_unique": "count(*) - count(DISTINCT question_id)",
    "no_html_entity": no_text("regexp_matches(x, '&[a-zA-Z#0-9]+;')"),
    "no_outer_space": no_text("x <> trim(x)"),
    "no_empty_text": no_text("x = ''"),
    "answer_not_among_wrong": fails("NOT list_contains(incorrect_answers, correct_answer)"),
    "no_duplicate_option": fails(
        "len(list_distinct(list_transform(incorrect_answers || [correct_answer], lambda x: lower(x))))"
        " = len(incorrect_answers) + 1"
    ),
    "option_count_matches_type": fails("nb_options = CASE type WHEN 'multiple' THEN 4 WHEN 'boolean' THEN 2 END"),
}
READ_BACK_CHECKS = {
    "row_count": "min(0)",
    "columns_kept": "min(0)",
    "wrong_answers_are_lists": fails("len(incorrect_answers) = nb_options - 1"),
}
block(
    "asked_again",
    attributes(
        """(SELECT seq, type, difficulty, category, correct_answer, incorrect_answers,
      CASE WHEN seq % 3 = 0 THEN upper('Which brand makes ' || p_name || '?')
        ELSE 'Which brand makes ' || p_name || '?' END AS question
    FROM q0 JOIN part ON p_partkey = seq)"""
    ),
    "q0",
)
CLEAN_COLUMNS = """question_id, type, difficulty, difficulty_level, category, category_group, category_name, question,
  correct_answer, incorrect_answers, nb_options"""

# --- Samples and follow-up ---


def permutation(seed):
    return f"""SELECT *, {seed} AS sample_seed,
  (row_number() OVER (ORDER BY md5('{seed}:' || question_id), question_id))::INT AS sample_rank FROM q"""


block("perm42", permutation(42), "q")
block("perm43", permutation(43), "q")
block("perm7", permutation(7), "q")
block(
    "work",
    """SELECT run_id, question_id, sample_seed, sample_rank
FROM runs JOIN (FROM perm42 UNION ALL FROM perm43) USING (sample_seed)""",
    "runs",
    "perm42",
    "perm43",
)
block(
    "todo",
    """SELECT run_id, question_id FROM
  (SELECT run_id, question_id FROM work WHERE run_id NOT LIKE 'm0%'
   UNION ALL SELECT run_id, question_id FROM graded WHERE model_key = 'm0')
WHERE (run_id, question_id) NOT IN (SELECT (run_id, question_id) FROM graded
  WHERE created_at < TIMESTAMP '1995-01-01' OR run_id = 'm0__v1_letters')""",
    "work",
    "graded",
)
TRIALS = """SELECT run_id, CASE WHEN regexp_matches(run_id, '^m[02]') THEN 'incomplète' ELSE 'terminée' END AS status,
  count_if(NOT failed) AS n_answers, count_if(failed) AS n_errors, count_if(NOT failed AND is_valid_format) AS n_valid,
  count_if(NOT failed AND ai_correct) AS n_right, CASE WHEN bool_and(failed) THEN 'aucune réponse'
    WHEN bool_or(failed) THEN 'erreurs' ELSE 'OK' END AS outcome
FROM (SELECT *, completion_tokens % 13 = 0 AND model_key <> 'm1' OR run_id = 'm3__v3_text' AS failed FROM graded
  WHERE len(string_split(run_id, '__')) = 2) GROUP BY run_id"""
RUN_SUMMARY = f"""SELECT run_id, status, CASE WHEN asked THEN coalesce(got, 0) ELSE 0 END AS n_new,
  CASE WHEN asked THEN {rnd(div('k', 'got'))} END AS provisional_accuracy,
  CASE WHEN asked THEN {rnd(div('v', 'got'))} END AS valid_format_rate,
  CASE WHEN asked THEN {rnd('seconds / 60.0', 1)} END AS duration_min
FROM (SELECT *, status NOT IN ('déjà terminée', 'modèle introuvable') AS asked
FROM (SELECT run_id, k, v, seconds, g.n AS got, CASE WHEN coalesce(t.n, 0) = 0 THEN 'déjà terminée'
    WHEN lmstudio_id = 'lab/model-3' THEN 'modèle introuvable' WHEN coalesce(g.n, 0) = t.n THEN 'terminée'
    ELSE 'incomplète' END AS status
FROM runs LEFT JOIN (SELECT run_id, count(*) AS n FROM todo GROUP BY 1) t USING (run_id)
LEFT JOIN (SELECT run_id, count(*) AS n, {RIGHT} AS k, count_if(is_valid_format) AS v,
    epoch(max(created_at)) - epoch(min(created_at)) AS seconds
  FROM graded WHERE created_at >= TIMESTAMP '1995-01-01' AND run_id <> 'm0__v1_letters' GROUP BY 1) g USING (run_id)))"""

# --- Lenient letters ---

block(
    "chatty",
    r"""SELECT CASE l_orderkey % 10 WHEN 0 THEN '{"answer": "' || x || '"}' WHEN 1 THEN '{"answer": " ' || x || ' "}'
    WHEN 2 THEN '{"answer": 1, "note": "' || x || '"}' WHEN 3 THEN x || ') Mars' WHEN 4 THEN '(' || x || ')'
    WHEN 5 THEN x || E' : x\n' WHEN 6 THEN 'The answer is (' || x || '), I think' WHEN 7 THEN 'I would say ANSWER: ' || x
    WHEN 8 THEN 'Because ' || x || '!' ELSE '{"reply": "' || x || '"}' END AS raw,
  CASE l_suppkey % 2 WHEN 0 THEN 2 ELSE 4 END AS nb, l_linenumber % 2 = 0 AS structured
FROM (SELECT *, 'ABCDE'[l_partkey % 5 + 1] AS x FROM lineitem)""",
)
LENIENT = r"""SELECT raw, nb, structured, CASE WHEN contains('ABCD'[1:nb], x) AND x <> '' THEN x END AS letter, n
FROM (SELECT *, CASE WHEN structured AND json_valid(txt) AND txt LIKE '{%}'
      THEN upper(trim(json_extract_string(txt, '$.answer')))
    WHEN contains('ABCD'[1:nb], lead) AND lead <> '' THEN lead
    ELSE upper(regexp_extract(txt, '(?i)answer\s*(?:is)?\s*:?\s*[(]?([A-D])\b', 1)) END AS x
  FROM (SELECT *, regexp_extract(txt, '^[(]?([A-D])\s*(?:[).:]|$)', 1) AS lead
    FROM (SELECT raw, nb, structured, trim(raw, E' \t\n\r') AS txt, count(*) AS n FROM chatty GROUP BY 1, 2, 3)))"""

# --- Reports ---

LABELS = {
    "prompt_version": {
        "v1_letters": "Lettres (A–D)",
        "v2_numbers": "Chiffres (1–4)",
        "v3_text": "Texte de la réponse",
        "v4_letters_hot": "Lettres, température 1",
    },
    "difficulty": {"easy": "Facile", "medium": "Moyen", "hard": "Difficile", "all": "Toutes"},
    "question_type": {"multiple": "QCM", "boolean": "Vrai/Faux"},
    "label_style": {"letters": "Lettres", "numbers": "Chiffres", "text": "Texte"},
}


def label(code, alias=None):
    return labels(code, LABELS[code]) + (f" AS {alias}" if alias else "")


SAMPLE_NOTE = """n_questions < 30 AS low_n,
  CASE WHEN n_questions < 30 THEN 'Échantillon faible : ' ELSE '' END || 'n = ' || n_questions AS sample_note"""
# Rank of an announced difficulty in display order.
LEVEL_RANK = "CASE {0} WHEN 'easy' THEN 0 WHEN 'medium' THEN 1 WHEN 'hard' THEN 2 ELSE 3 END"

REPORTS = {
    "volumes": (
        """SELECT sum(n_questions)::BIGINT AS n_responses, count(DISTINCT model_key) AS n_models,
  count(DISTINCT prompt_version) AS n_prompts, count(*) AS n_runs,
  (SELECT count(*) FROM mart_question_insights) AS n_questions FROM mart_leaderboard""",
        ("mart_leaderboard", "mart_question_insights"),
    ),
    "leaderboard_selection": (
        f"""SELECT *, {label('prompt_version', 'prompt_label')}, {label('label_style', 'format_label')},
  model_name || ' · ' || {label('prompt_version')} AS run_label
FROM mart_leaderboard WHERE model_key IN ('m0', 'm2', 'm3')""",
        ("mart_leaderboard",),
    ),
    "winner_vs_runner_up": (
        f"""SELECT prompt_version, m[1] AS best_model, a[1] AS best_accuracy, m[2] AS second_model, a[2] AS second_accuracy,
  {rnd('a[1] - a[2]')} AS gap, lo[1] > hi[2] AS is_significant, n_questions_min, n_questions_max, n_models
FROM (SELECT prompt_version, list(model_name ORDER BY accuracy DESC, model_key) AS m,
    list(accuracy ORDER BY accuracy DESC, model_key) AS a, list(accuracy_ci_low ORDER BY accuracy DESC, model_key) AS lo,
    list(accuracy_ci_high ORDER BY accuracy DESC, model_key) AS hi, min(n_questions) AS n_questions_min,
    max(n_questions) AS n_questions_max, count(*) AS n_models FROM mart_leaderboard GROUP BY 1)""",
        ("mart_leaderboard",),
    ),
    "status_shares": (
        f"""SELECT model_name, prompt_version, n_questions, {SAMPLE_NOTE}, s.status, s.share
FROM (SELECT *, unnest([{{'status': 'Juste', 'share': accuracy}},
    {{'status': 'Faux', 'share': {rnd('valid_format_rate - accuracy')}}},
    {{'status': 'Format invalide', 'share': {rnd('1 - valid_format_rate')}}}]) AS s FROM mart_leaderboard)""",
        ("mart_leaderboard",),
    ),
    "profile_report": (
        """SELECT p.*, random_baseline FROM mart_model_profile p LEFT JOIN (
  SELECT DISTINCT ON (model_key) model_key, random_baseline FROM mart_leaderboard WHERE temperature = 0
  ORDER BY model_key, prompt_version) USING (model_key)""",
        ("mart_model_profile", "mart_leaderboard"),
    ),
    "profile_summary": (
        """SELECT m[1] AS best_model, fast[1] AS fastest_model, big[1] AS largest_model,
  len(m) > 1 AND s = list_reverse_sort(s) AS size_follows_accuracy
FROM (SELECT list(model_name ORDER BY accuracy DESC, model_key) AS m, list(model_params_b ORDER BY accuracy DESC, model_key) AS s,
  list(model_name ORDER BY avg_response_time_s, model_key) AS fast,
  list(model_name ORDER BY model_params_b DESC, model_key) AS big FROM mart_model_profile)""",
        ("mart_model_profile",),
    ),
    "knowledge_vs_format": (
        """SELECT model_key, model_name, model_params_b, n_responses, valid_format_rate, 'Précision' AS measure,
  accuracy AS value FROM mart_model_profile
UNION ALL SELECT model_key, model_name, model_params_b, n_responses, valid_format_rate, 'Précision si format valide',
  accuracy_when_valid FROM mart_model_profile""",
        ("mart_model_profile",),
    ),
    "format_report": (
        f"""SELECT f.*, {label('prompt_version', 'prompt_label')}, {label('label_style', 'format_label')},
  {SAMPLE_NOTE.replace('n_questions', 'f.n_questions')}, l.accuracy_ci_low, l.accuracy_ci_high, l.random_baseline
FROM mart_prompt_format f LEFT JOIN (SELECT model_key, prompt_version, accuracy_ci_low, accuracy_ci_high, random_baseline
  FROM mart_leaderboard) l USING (model_key, prompt_version)""",
        ("mart_prompt_format", "mart_leaderboard"),
    ),
    "format_means": (
        f"SELECT {label('label_style', 'format_label')}, {rnd('avg(accuracy)')} AS mean_accuracy "
        "FROM mart_prompt_format GROUP BY 1",
        ("mart_prompt_format",),
    ),
    "most_format_sensitive": (
        f"""SELECT model_name, {label('label_style', 'format_label')}, accuracy_delta_vs_letters FROM mart_prompt_format
WHERE label_style <> 'letters' ORDER BY abs(accuracy_delta_vs_letters) DESC, model_key, prompt_version LIMIT 1""",
        ("mart_prompt_format",),
    ),
    "temperature_report": (
        """SELECT t.*, l.random_baseline FROM mart_temperature_effect t LEFT JOIN mart_leaderboard l
  ON l.model_key = t.model_key AND l.prompt_version = 'v1_letters' WHERE t.difficulty = 'all'""",
        ("mart_temperature_effect", "mart_leaderboard"),
    ),
    "temperature_extremes": (
        """SELECT arg_min(model_name, row(accuracy_delta, model_key)) AS worst_model, min(accuracy_delta) AS worst_delta,
  arg_min(model_name, row(-answer_stability, model_key)) AS steadiest_model, max(answer_stability) AS best_stability
FROM mart_temperature_effect WHERE difficulty = 'all'""",
        ("mart_temperature_effect",),
    ),
    "temperature_by_difficulty": (
        f"""SELECT *, {label('difficulty', 'difficulty_label')}, {SAMPLE_NOTE} FROM mart_temperature_effect
WHERE difficulty <> 'all'""",
        ("mart_temperature_effect",),
    ),
    "cold_hot_long": (
        """SELECT model_name, n_questions, accuracy_delta, 'Température 0' AS run, accuracy_cold AS accuracy
FROM mart_temperature_effect WHERE difficulty = 'all'
UNION ALL SELECT model_name, n_questions, accuracy_delta, 'Température 1', accuracy_hot
FROM mart_temperature_effect WHERE difficulty = 'all'""",
        ("mart_temperature_effect",),
    ),
    "lost_and_gained": (
        """SELECT model_name, n_questions, 'Perdues (juste → faux)' AS direction, 0 - rate_correct_to_wrong AS share,
  rate_correct_to_wrong AS rate FROM mart_temperature_effect WHERE difficulty = 'all'
UNION ALL SELECT model_name, n_questions, 'Gagnées (faux → juste)', rate_wrong_to_correct, rate_wrong_to_correct
FROM mart_temperature_effect WHERE difficulty = 'all'""",
        ("mart_temperature_effect",),
    ),
    "family_rollup": (
        f"""SELECT model_key, model_name, category_group AS category, k AS n_correct, n AS n_questions, own AS model_accuracy,
  {rnd(div('k', 'n'))} AS accuracy, {rnd(div('k', 'n') + ' - own')} AS delta_vs_model_average,
  {rnd('everyone')} AS category_accuracy_all_models,
  rank() OVER (PARTITION BY category_group ORDER BY k::DOUBLE / n DESC) AS rank_in_category,
  dense_rank() OVER (ORDER BY everyone DESC, category_group) AS theme_order
FROM (SELECT *, (sum(k) OVER g)::DOUBLE / sum(n) OVER g AS everyone
  FROM (SELECT model_key, model_name, category_group, sum(n_correct)::BIGINT AS k, sum(n_questions)::BIGINT AS n,
      any_value(model_accuracy) AS own FROM mart_perf_by_category WHERE prompt_version = 'v1_letters' GROUP BY 1, 2, 3)
  WINDOW g AS (PARTITION BY category_group))""",
        ("mart_perf_by_category",),
    ),
    "category_order": (
        """SELECT DISTINCT category_group, category_name, category_accuracy_all_models FROM mart_perf_by_category
WHERE prompt_version = 'v1_letters'""",
        ("mart_perf_by_category",),
    ),
    "category_wins": (
        """SELECT model_key, model_name, count(DISTINCT category_name) FILTER (is_best_in_category) AS n_wins
FROM mart_perf_by_category WHERE prompt_version = 'v1_letters' GROUP BY 1, 2""",
        ("mart_perf_by_category",),
    ),
    "strong_and_weak_categories": (
        """SELECT model_key, category_group, category_name, delta_vs_model_average, up <= 3 AS is_strong, down <= 3 AS is_weak
FROM (SELECT *, row_number() OVER (PARTITION BY model_key
      ORDER BY delta_vs_model_average DESC, category_group, category_name) AS up,
    row_number() OVER (PARTITION BY model_key
      ORDER BY delta_vs_model_average, category_group DESC, category_name DESC) AS down
  FROM mart_perf_by_category WHERE prompt_version = 'v1_letters') WHERE up <= 3 OR down <= 3""",
        ("mart_perf_by_category",),
    ),
    "subgroup_hypothesis": (
        f"""SELECT model_key, model_name, n AS n_questions, {rnd('acc')} AS subgroup_accuracy, {rnd('acc - own')} AS delta,
  model_key = 'm2' AS is_target,
  coalesce(model_key = 'm2' AND acc - own < (min(acc - own) FILTER (model_key <> 'm2') OVER ()), false) AS supports_hypothesis
FROM (SELECT model_key, model_name, sum(n_questions)::BIGINT AS n, sum(n_correct)::DOUBLE / sum(n_questions) AS acc,
    any_value(model_accuracy) AS own FROM mart_perf_by_category
  WHERE prompt_version = 'v1_letters' AND category_name IN ('ECONOMY', 'STANDARD', 'Nature') GROUP BY 1, 2)""",
        ("mart_perf_by_category",),
    ),
    "difficulty_drop": (
        f"""SELECT model_name, {rnd('e')} AS easy, {rnd('h')} AS hard, {rnd('e - h')} AS "drop"
FROM (SELECT model_name,
    sum(n_correct) FILTER (difficulty = 'easy')::DOUBLE / sum(n_questions) FILTER (difficulty = 'easy') AS e,
    sum(n_correct) FILTER (difficulty = 'hard')::DOUBLE / sum(n_questions) FILTER (difficulty = 'hard') AS h
  FROM mart_perf_by_difficulty WHERE prompt_version = 'v1_letters' GROUP BY 1)""",
        ("mart_perf_by_difficulty",),
    ),
    "difficulty_pivot": (
        "SELECT model_name, "
        + ", ".join(
            f"max(accuracy) FILTER (difficulty = '{d}' AND question_type = '{t}') * 100 AS {d}_{t}"
            for t in ("multiple", "boolean")
            for d in ("easy", "medium", "hard")
        )
        + " FROM mart_perf_by_difficulty WHERE prompt_version = 'v1_letters' GROUP BY 1",
        ("mart_perf_by_difficulty",),
    ),
    "facet_baseline": (
        f"""SELECT {label('question_type', 'type_label')}, {rnd('avg(random_baseline)')} AS mean_baseline
FROM mart_perf_by_difficulty WHERE prompt_version = 'v1_letters' GROUP BY 1""",
        ("mart_perf_by_difficulty",),
    ),
    "strongest_bias": (
        """SELECT prompt_version, question_type, model_name, position_label, share_chosen, share_expected, position_bias
FROM mart_position_bias QUALIFY row_number() OVER (PARTITION BY prompt_version, question_type
  ORDER BY abs(position_bias) DESC, model_key, position) = 1""",
        ("mart_position_bias",),
    ),
    "true_share": (
        """SELECT model_name, prompt_version, share_chosen, share_expected, position_bias FROM mart_position_bias
WHERE question_type = 'boolean' AND position_label = 'True'""",
        ("mart_position_bias",),
    ),
    "position_shares": (
        "\nUNION ALL ".join(
            f"""SELECT model_name, prompt_version, question_type, position, position_label, n_chosen, n_correct_here,
  position_bias, '{text}' AS measure, {column} AS share FROM mart_position_bias"""
            for column, text in (
                ("share_chosen", "Réponses du modèle"),
                ("share_expected", "Bonnes réponses réelles"),
            )
        ),
        ("mart_position_bias",),
    ),
    "question_search": (
        """SELECT * FROM mart_question_insights WHERE category_group IN ('Entertainment', 'Science')
  AND difficulty IN ('easy', 'hard') AND lower(question_text) LIKE '%small%'""",
        ("mart_question_insights",),
    ),
    "question_explorer": (
        f"""SELECT * REPLACE (success_rate * 100 AS success_rate), {label('difficulty', 'difficulty_label')},
  {label('question_type', 'type_label')}, {labels('ai_difficulty', LABELS['difficulty'])} AS ai_difficulty_label
FROM mart_question_insights""",
        ("mart_question_insights",),
    ),
    "trap_list": (
        """SELECT question_id, question_text, category_name, difficulty, correct_answer, top_wrong_answer, top_wrong_votes,
  n_answers FROM mart_question_insights WHERE is_common_trap""",
        ("mart_question_insights",),
    ),
    "trap_summary": (
        f"""SELECT count(*) AS n_questions, {rnd('avg(is_all_wrong::INT)')} AS all_wrong_share,
  count_if(is_all_wrong)::BIGINT AS n_all_wrong, count_if(is_common_trap)::BIGINT AS n_traps,
  {rnd('avg(is_all_correct::INT)')} AS all_correct_share, count_if(is_all_correct)::BIGINT AS n_all_correct
FROM mart_question_insights""",
        ("mart_question_insights",),
    ),
    "majority_vs_best": (
        f"""SELECT {rnd('crowd')} AS majority_accuracy, model_name AS best_model, accuracy AS best_accuracy,
  {rnd('crowd - accuracy')} AS gain, crowd > accuracy AS majority_is_better
FROM (SELECT avg(is_majority_correct::INT) AS crowd FROM mart_question_insights),
  (SELECT model_name, accuracy FROM mart_model_profile ORDER BY accuracy DESC, model_key LIMIT 1)""",
        ("mart_question_insights", "mart_model_profile"),
    ),
    "difficulty_crosstab": (
        f"""SELECT announced, lived, count(i.question_id) AS n,
  {rnd('count(i.question_id)::DOUBLE / sum(count(i.question_id)) OVER (PARTITION BY announced)')} AS row_share,
  (SELECT {rnd('avg((difficulty = ai_difficulty)::INT)')} FROM mart_question_insights) AS agreement
FROM (SELECT DISTINCT difficulty AS announced FROM mart_question_insights) a
CROSS JOIN (VALUES ('easy'), ('medium'), ('hard')) v(lived)
LEFT JOIN mart_question_insights i ON i.difficulty = announced AND i.ai_difficulty = lived GROUP BY 1, 2""",
        ("mart_question_insights",),
    ),
    "success_histogram": (
        f"""SELECT round(success_rate * n_answers)::INT AS score, round(success_rate * n_answers)::INT || '/' || n_answers AS bucket,
  difficulty, count(*) AS n, {LEVEL_RANK.format('difficulty')} AS color_rank
FROM mart_question_insights GROUP BY ALL""",
        ("mart_question_insights",),
    ),
    "model_display_order": (
        """SELECT model_key, model_name, row_number() OVER (ORDER BY model_params_b, model_name, model_key) AS display_order
FROM mart_model_profile""",
        ("mart_model_profile",),
    ),
    "model_fallback_order": (
        """SELECT model_key, model_name, row_number() OVER (
  ORDER BY CASE model_key WHEN 'm3' THEN 0 WHEN 'm1' THEN 1 ELSE 2 END, model_name, model_key) AS display_order
FROM (SELECT DISTINCT model_key, model_name FROM mart_position_bias)""",
        ("mart_position_bias",),
    ),
    "difficulty_display_order": (
        f"""SELECT difficulty, row_number() OVER (ORDER BY {LEVEL_RANK.format('difficulty')}, difficulty) AS display_order
FROM (SELECT DISTINCT difficulty FROM mart_temperature_effect)""",
        ("mart_temperature_effect",),
    ),
    "dimension_labels": (
        f"""SELECT prompt_version, {label('prompt_version', 'prompt_label')}, difficulty,
  {label('difficulty', 'difficulty_label')}, question_type, {label('question_type', 'type_label')}, label_style,
  {label('label_style', 'format_label')}, count(*) AS n FROM enr GROUP BY ALL""",
        ("enr",),
    ),
}

TIDY = f"trim(regexp_replace(translate(text, chr(160) || chr(173), ' '), '{PYTHON_SPACE}+', ' ', 'g'))"
# The entities these pages hold. The ampersand comes last so that nothing is decoded twice; like other
# old entities it also counts without its semicolon.
DECODED = "html"
for _entity, _code in (("&quot;", 34), ("&middot;", 183), ("&copy;", 169)):
    DECODED = f"replace({DECODED}, '{_entity}', chr({_code}))"
DECODED = f"regexp_replace({DECODED}, '&amp;?', '&', 'g')"

ORACLES = {
    "contract_bronze": oracle(report_sql("bronze", RAW_CHECKS, "faulty_raw"), "faulty_raw"),
    "contract_silver": oracle(report_sql("silver", CLEAN_CHECKS, "faulty_clean"), "faulty_clean"),
    "contract_silver_while_writing": oracle(report_sql("silver", CLEAN_CHECKS, "faulty_clean"), "faulty_clean"),
    "quarantined_questions": oracle(
        f"""SELECT * FROM (SELECT type, difficulty, category, question, correct_answer, {FAILED_CHECKS} AS failed_checks
FROM faulty_raw) WHERE failed_checks <> ''""",
        "faulty_raw",
    ),
    "accepted_questions": oracle(
        f"""SELECT type, difficulty, category, count(DISTINCT (lower(question), lower(correct_answer))) AS n_questions
FROM faulty_raw WHERE {FAILED_CHECKS} = '' GROUP BY ALL""",
        "faulty_raw",
    ),
    "contract_read_back": oracle(report_sql("silver file", READ_BACK_CHECKS, "q"), "q"),
    "raw_question_file": oracle(
        f"""SELECT type, difficulty, category, question, correct_answer,
  '["' || array_to_string(incorrect_answers, '","') || '"]' AS incorrect_answers FROM q0""",
        "q0",
    ),
    "page_file": oracle(
        """SELECT type, difficulty, category, question || suffix AS question, correct_answer, incorrect_answers
FROM q0, (VALUES (''), (' (bis)')) v(suffix) WHERE seq % 10 NOT IN (3, 7, 9)""",
        "q0",
    ),
    "first_collected": oracle(
        """SELECT type, difficulty, category, question || suffix AS question, correct_answer, incorrect_answers
FROM q0, (VALUES (1, ''), (2, ' (bis)')) v(place, suffix) WHERE seq % 10 NOT IN (3, 7, 9) ORDER BY seq, place LIMIT 150""",
        "q0",
    ),
    "clean_question_file": oracle(f"SELECT {CLEAN_COLUMNS} FROM q", "q"),
    "run_config_file": oracle(
        """SELECT run_order, run_id, model_key, lmstudio_id, model_name, publisher, country, params_b, disable_thinking,
  prompt_version, label_style, prompt_description, system_prompt, user_template, temperature, max_tokens, n_questions,
  sample_seed FROM runs WHERE run_order <= 12""",
        "runs",
    ),
    "prompt_set_file": oracle(
        """SELECT DISTINCT prompt_version, system_prompt, user_template, prompt_version = 'v2_numbers' AS structured
FROM runs""",
        "runs",
    ),
    "response_file": oracle("SELECT * FROM resp", "resp"),
    "answered_pairs_file": oracle("SELECT run_id, question_id FROM resp", "resp"),
    "published_leaderboard": oracle("SELECT * FROM mart_leaderboard", "mart_leaderboard"),
    "built_leaderboard": oracle("SELECT * FROM mart_leaderboard", "mart_leaderboard"),
    "clean_text_documents": f"SELECT doc_id, lang, {TIDY} AS clean_text FROM documents",
    "clean_html_pages": f"SELECT page_id, {TIDY.replace('(text,', f'({DECODED},')} AS clean_html FROM pages",
    "flatten_api_pages": oracle(
        """SELECT type, difficulty, category, question || suffix AS question, correct_answer, incorrect_answers
FROM q0, (VALUES (''), (' (bis)')) v(suffix) WHERE seq % 10 NOT IN (3, 7, 9)""",
        "q0",
    ),
    "category_split": oracle(
        "SELECT seq, category, category_group, category_name, difficulty_level, nb_options FROM q", "q"
    ),
    "question_ids_dedup": oracle(
        f"SELECT DISTINCT ON (question_id) {CLEAN_COLUMNS} FROM asked_again ORDER BY question_id, seq", "asked_again"
    ),
    "duplicate_groups": oracle(
        """SELECT question_id, seq, category, question, correct_answer FROM asked_again
QUALIFY count(*) OVER (PARTITION BY question_id) > 1""",
        "asked_again",
    ),
    "duplicate_summary": oracle(
        """SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_kept, count_if(n > 1)::BIGINT AS n_duplicated_keys,
  (sum(n) - count(*))::BIGINT AS n_removed FROM (SELECT count(*) AS n FROM asked_again GROUP BY question_id)""",
        "asked_again",
    ),
    "seeded_permutation": oracle(
        "SELECT question_id, sample_seed, sample_rank FROM perm42 UNION ALL "
        "SELECT question_id, sample_seed, sample_rank FROM perm7",
        "perm42",
        "perm7",
    ),
    "seeded_sample": oracle(
        "SELECT question_id, difficulty, sample_seed, sample_rank FROM perm42 WHERE sample_rank <= 150", "perm42"
    ),
    "first_questions_by_id": oracle("SELECT question_id, question FROM q ORDER BY question_id LIMIT 120", "q"),
    "resume_work_list": oracle("SELECT * FROM work ANTI JOIN resp USING (run_id, question_id)", "work", "resp"),
    "resume_on_triple_key": oracle(
        """SELECT question_id, model_key AS model, prompt_version FROM resp a WHERE NOT EXISTS (FROM resp b
  WHERE b.created_at < '1995-01-01T00:00:00' AND b.question_id = a.question_id AND b.model_key = a.model_key
    AND b.prompt_version = a.prompt_version)""",
        "resp",
    ),
    "build_choices": oracle(
        f"""SELECT question_id, choices, 'ABCD'[place] AS letters_label, place::VARCHAR AS numbers_label,
  choices[place] AS text_label, array_to_string(list_transform(list_zip(['A','B','C','D'][1:len(choices)], choices),
    lambda z: z[1] || ') ' || z[2]), E'\\n') AS listing
FROM (SELECT *, list_position(choices, correct_answer) AS place FROM (SELECT *, {choices()} AS choices FROM q))""",
        "q",
    ),
    "render_prompts": oracle(
        """SELECT run_id, question_id, choices, correct_label, system_prompt, user_prompt,
  system_prompt || E'\\n\\n' || user_prompt AS prompt_text FROM resp""",
        "resp",
    ),
    "run_summary": oracle(RUN_SUMMARY, "todo", "graded", "runs"),
    "trial_summary": oracle(TRIALS, "graded"),
    "followed_trials": oracle(TRIALS, "graded"),
    "projected_minutes": oracle(
        f"""SELECT lmstudio_id, n_runs, {rnd('pace', 2)} AS seconds_per_question, {rnd('pace * 1000 * n_runs / 60', 1)} AS projected_min
FROM (SELECT lmstudio_id, count(*) AS n_runs FROM runs GROUP BY 1)
JOIN (SELECT lmstudio_id, avg(response_time) AS pace FROM resp GROUP BY 1) USING (lmstudio_id)""",
        "runs",
        "resp",
    ),
    "one_run_per_model": oracle(
        """SELECT DISTINCT ON (lmstudio_id) * FROM runs WHERE prompt_version = 'v3_text'
ORDER BY lmstudio_id, run_order""",
        "runs",
    ),
    "invalid_examples": oracle(
        """SELECT run_id, question_id, raw_response FROM graded WHERE NOT is_valid_format
ORDER BY run_id, question_id LIMIT 5""",
        "graded",
    ),
    "stage_questions": oracle("SELECT * FROM stq", "stq"),
    "stage_responses": oracle("SELECT * FROM str", "str"),
    "grade_responses": oracle("SELECT * FROM graded", "graded"),
    "grade_stream": oracle("SELECT * FROM graded", "graded"),
    "grade_stream_watermarked": oracle("SELECT * FROM graded", "graded"),
    # A watermark drops what is older than the newest response less the delay; all of the first half is.
    "grade_stream_expiring": oracle(
        """SELECT year::INT AS year, count(*) AS n FROM (
  SELECT year(created_at) AS year FROM graded
  UNION ALL SELECT year(created_at) + 20 FROM graded WHERE created_at < TIMESTAMP '1995-01-01') GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM graded WHERE created_at < TIMESTAMP '1995-01-01'
  AND created_at <= (SELECT max(created_at) FROM graded) - INTERVAL 30 DAY""",
        "graded",
    ),
    "lenient_letters": oracle(LENIENT, "chatty"),
    "enriched": oracle("SELECT * FROM enr", "enr"),
    "answer_option_table": oracle(
        """SELECT question_id, correct_answer AS option_text, true AS is_correct FROM stq
UNION ALL SELECT question_id, unnest(incorrect_answers), false FROM stq""",
        "stq",
    ),
    "quality_by_source": f"""SELECT source, n AS n_labelled, k AS n_good, {rnd(div('k', 'n'))} AS share_good,
  {rnd(wilson('k', 'n', '-'))} AS ci_low, {rnd(wilson('k', 'n', '+'))} AS ci_high
FROM (SELECT source, count(*) AS n, sum(quality)::BIGINT AS k FROM labels JOIN documents USING (doc_id) GROUP BY 1)""",
}
for _name in [name for name in BLOCKS if name.startswith("mart_")]:
    ORACLES[_name.removeprefix("mart_")] = oracle(f"SELECT * FROM {_name}", _name)
for _name in ("leaderboard", "question_insights", "temperature_effect", "prompt_format"):
    ORACLES[f"followed_{_name}"] = ORACLES[_name]
ORACLES["paired_temperature_effect"] = ORACLES["temperature_effect"]
ORACLES["bucketed_enriched"] = ORACLES["enriched"]
ORACLES["bucketed_question_insights"] = ORACLES["question_insights"]
ORACLES["bucketed_resume"] = ORACLES["resume_work_list"]
_marts = [name for name in BLOCKS if name.startswith("mart_")]
ORACLES["built_tables"] = oracle(
    " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows FROM {name}" for name in _marts), *_marts
)
for _name, (_sql, _needs) in REPORTS.items():
    ORACLES[_name] = oracle(_sql, *_needs)
ORACLES["question_search_indexed"] = ORACLES["question_search"]
