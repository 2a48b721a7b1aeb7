"""Declared schemas as DDL text, so that no read has to infer one with an extra pass."""

# --- fixed values: columns of the raw tables ---------------------------------
COMMENTS = """
    author string, author_cakeday boolean, author_flair_css_class string,
    author_flair_text string, body string, can_gild boolean, can_mod_post boolean,
    collapsed boolean, collapsed_reason string, controversiality bigint,
    created_utc bigint, distinguished string, edited string, gilded bigint, id string,
    is_submitter boolean, link_id string, parent_id string, permalink string,
    retrieved_on bigint, score bigint, stickied boolean, subreddit string,
    subreddit_id string, subreddit_type string
"""
THREADS = "id string, title string, score bigint"
LABELS = "Input_id string, labeldem string, labelgop string, labeldjt string"

# --- fixed values: columns of the report files -------------------------------
OVERALL = "Positive double, Negative double"
BY_DAY = "date string, Positive double, Negative double"
BY_REGION = "state string, Positive double, Negative double"
BY_THREAD_SCORE = "submission_score bigint, Positive double, Negative double"
BY_COMMENT_SCORE = "comment_score bigint, Positive double, Negative double"
TOP_THREADS = (
    "submission_id string, submission_score bigint, Positive double, Negative double"
)
