"""Constants that have to equal the task's published ones for the
results to match. They are listed here together and nowhere else."""

# Category names and their ids.
TAG_IDS = {
    "Unbalanced_power_relations": 0,
    "Shallow_solution": 1,
    "Presupposition": 2,
    "Authority_voice": 3,
    "Metaphors": 4,
    "Compassion": 5,
    "The_poorer_the_merrier": 6,
}

# Short names of the seven positions of a label vector, in vector order.
VECTOR_NAMES = ("unb", "sha", "pre", "aut", "met", "com", "the")

# Task names; a submission holds one label file per task.
TASK_FILES = {"task1": "task1.txt", "task2": "task2.txt"}

# File layouts.
HEADER_LINES = 4
GRADED_COLUMNS = ("par_id", "art_id", "keyword", "country", "text", "label")
ANNOTATION_COLUMNS = (
    "par_id", "art_id", "text", "keyword", "country",
    "start", "finish", "text_span", "label", "num_annotators",
)
UNLABELLED_COLUMNS = ("par_id", "art_id", "keyword", "country", "text")
METRICS_LOG_COLUMNS = ("epoch", "train_loss", "dev_f1_05", "best_tuned_f1", "threshold")

# Grades that count as negative; every other string is positive.
NEGATIVE_GRADES = ("0", "1")
MIN_VOTES = 2

# Length bins, closed on the right.
LENGTH_EDGES = (0, 20, 40, 60, 80, 100, 200, 1000)
LENGTH_LABELS = ("0-20", "21-40", "41-60", "61-80", "81-100", "101-200", "200+")

# Threshold grid, default decision threshold and nominal operating point.
GRID_LOW, GRID_HIGH, GRID_STEP = 0.1, 0.9, 0.01
DEFAULT_THRESHOLD = 0.5
NOMINAL_THRESHOLD = 0.12

# Loss, truncation, sampling and reporting defaults.
FOCAL_GAMMA = 2.0
LABEL_SMOOTHING = 0.1
MAX_TOKENS = 128
SEED = 42
SAMPLE_SIZE = 10
SNIPPET_CHARS = 200
HISTOGRAM_BINS = 50
NGRAM_SIZE = 2
TOP_K = 20

# Characters that Python's str.strip() and str.split() treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)

# English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
