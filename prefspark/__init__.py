"""PySpark engine for chat and preference data.

Every operator is a ``DataFrame -> DataFrame`` function; import them from
here or from their modules.
"""

from prefspark.operators.generate import batch_generate, batch_requests, clean_lines, select_candidates
from prefspark.operators.judge import (
    judge_input,
    judge_query,
    judge_score,
    pair_completions,
    pick_winner,
    preference_pairs,
    rubric_score,
    score_pairs,
    truncate_input,
    win_report,
)
from prefspark.operators.objective import eos_penalty, loss_report, preference_loss
from prefspark.operators.ordinal import exact_ordinal, hash_ordinal, with_row_id
from prefspark.operators.prompts import (
    decode_messages,
    instruction_to_prompt,
    messages_to_prompt,
    prepare_prompts,
    rename_prompt,
)
from prefspark.operators.rubric_fit import fit_rubric_weights, pair_loss
from prefspark.operators.sampling import (
    assign_batches,
    limit_samples,
    seeded_shuffle,
    split_counts,
    train_eval_split,
)
from prefspark.operators.sessions import (
    build_messages,
    context_links,
    render_chat,
    replay_messages,
    replay_sessions,
    session_from_json,
    session_history,
    session_to_json,
    sessions_from_turns,
    turn_contexts,
    unfold_contexts,
)
from prefspark.sources import (
    read_prompt_lines,
    read_prompts,
    read_responses,
    read_sessions,
    write_metrics,
    write_prepared,
    write_responses,
    write_sessions,
)
from prefspark.streaming import final_sessions, live_sessions, read_prompts_stream, replay_sessions_stream

__version__ = "0.1.0"

__all__ = [name for name in dir() if not name.startswith("_")]
