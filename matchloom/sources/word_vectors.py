"""Word vectors from text files: ``word f1 f2 ... fN`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The stop words that never enter the dictionary. Case-sensitive, with
# typographic apostrophes; the two punctuation marks come last.
STOP_WORDS = (
    "a,about,above,after,again,against,all,am,an,and,any,are,as,at,be,because,been,before,being,"
    "below,between,both,but,by,could,did,do,does,doing,down,during,each,few,for,from,further,had,"
    "has,have,having,he,he’d,he’ll,he’s,her,here,here’s,hers,herself,him,himself,his,how,how’s,I,"
    "I’d,I’ll,I’m,I’ve,if,in,into,is,it,it’s,its,itself,let’s,me,more,most,my,myself,nor,of,on,"
    "once,only,or,other,ought,our,ours,ourselves,out,over,own,same,she,she’d,she’ll,she’s,should,"
    "so,some,such,than,that,that’s,the,their,theirs,them,themselves,then,there,there’s,these,they,"
    "they’d,they’ll,they’re,they’ve,this,those,through,to,too,under,until,up,very,was,we,we’d,"
    "we’ll,we’re,we’ve,were,what,what’s,when,when’s,where,where’s,which,while,who,who’s,whom,why,"
    "why’s,with,would,you,you’d,you’ll,you’re,you’ve,your,yours,yourself,yourselves"
).split(",") + [",", "."]


def without_stop_words(df: DataFrame, word: str = "word") -> DataFrame:
    return df.where(~F.col(word).isin(STOP_WORDS))


def parse_word_vectors(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines to ``word STRING, vec ARRAY<FLOAT>``, one row per word, stop words removed.

    A table keeps no line order, so of several lines for a word the greatest vector stays.
    """
    parts = F.split(F.col(value), " ")
    numbers = F.filter(F.slice(parts, 2, F.size(parts)), lambda part: F.length(part) > 0)
    parsed = lines.select(parts[0].alias("word"), numbers.cast("array<float>").alias("vec"))
    return without_stop_words(parsed).groupBy("word").agg(F.max("vec").alias("vec"))


def load_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    return parse_word_vectors(spark.read.text(path))
