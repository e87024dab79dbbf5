"""Settings of the registered queries.

The prose of the test tables is invented, so the word lists are made of tokens that occur in it.
"""

from datetime import datetime

from alertflow.operators.extraction import DictionaryExtractor, PhraseExtractor
from alertflow.operators.scoring import LexiconScorer

# Word lists for the test tables.
LEXICON = ("that", "with", "this", "tion")
TYPES = ("from", "ment", "rewh", "elle")
PLACES = ("orre", "thatin", "ononst", "inoran")

PHRASE_TYPES = ("that", "that the", "of the", "of", "from the", "elle", "elle est")
PHRASE_PLACES = ("in", "in the", "in the of", "orre", "for that", "de la", "la", "to be")

SCORER = LexiconScorer(LEXICON)
EXTRACTOR = DictionaryExtractor(places=PLACES, types=TYPES)
PHRASES = PhraseExtractor(places=PHRASE_PLACES, types=PHRASE_TYPES)

# Document n of the feed is a message sent n * 10 seconds after this moment.
FEED_START = datetime(2024, 1, 1)
FEED_STEP_SECONDS = 10

REPORT_ROWS = 10
# Few, so that small tables make many files too.
ROWS_PER_FILE = 20
ONE_TYPE = "elle"
ONE_PLACE = "orre"
RANGE = (datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 2, 0))
WINDOW = "1 hour"

# A response that holds no JSON object reads as malformed.
REQUEST = "Where and what?\nSentence: {text}"

# All tokens of the benchmark texts serve as a term table: the longer ones as types, others as places.
TYPE_LENGTH = 8
# Most documents hold several of them, so one counts for little.
TABLE_WEIGHT = 1 / 64
TABLE_BIAS = -1.0
