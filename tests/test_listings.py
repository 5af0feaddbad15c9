"""Options listed once per question, and used wherever the question is asked."""

from pyspark.sql import functions as F

from askgauge.operators import prompting

GIVEN = "label_style string, choices array<string>, correct_answer string"


def test_listings_are_the_rendered_options_and_are_used(spark):
    rows = [(s, c, "x") for s in ("letters", "numbers", "text", "else", None) for c in (["x", "y"], [], [None, "x"], None)]
    asked = spark.createDataFrame(rows, GIVEN).withColumns(
        {"question": F.lit("Q {options}?"), "user_template": F.lit("{question}|{options}|"), "system_prompt": F.lit("s"),
         "disable_thinking": F.lit("false")})
    listed = asked.withColumn("listings", prompting.option_listings(F.col("choices")))
    plain = [r.user_prompt for r in prompting.render_prompts(asked).collect()]
    assert plain == [r.user_prompt for r in prompting.render_prompts(listed).collect()] and plain[0] == "Q {options}?|A. x\nB. y|"
    marked = listed.withColumn("listings", F.create_map(F.lit("text"), F.lit("listed before")))
    shown = prompting.render_prompts(marked.where("label_style = 'text'")).select("user_prompt").distinct().collect()
    assert [r.user_prompt for r in shown] == ["Q {options}?|listed before|"]
