"""Fixed values and schemas of the domain: accession grammar, primers, thresholds, table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# The accession grammar of the public archives.
RUN, PROJECT = r"^[CEDS]RR\d+$", r"^PRJ[CEDN][A-Z]\d+$"
BIOSAMPLE, EXPERIMENT = r"^SAM[CEDN][A-Z]?\d+$", r"^[CEDS]RX\d+$"
#: Names that a column takes if all its values follow the pattern, in the order in which they are tried.
CONTENT_PATTERNS = {"Run": RUN, "BioProject": PROJECT, "BioSample": BIOSAMPLE, "Experiment": EXPERIMENT}
#: Routes of an identifier, first match first.
ROUTES = {"biosample": BIOSAMPLE, "cncb": r"^PRJC[A-Z]\d+$", "ncbi": r"^PRJ[EDN][A-Z]\d+$"}
# Columns that come first, and the affixes by which joined sources mark their columns.
PRIORITY_COLUMNS = ["Run", "BioProject", "BioSample", "Experiment"]
SOURCE_PREFIXES, SOURCE_SUFFIXES = r"^(?:Sample_|Experiment_|Run_)(?=.)", r"(?:_sra|_biosample|_x|_y)$"

# Known 16S primers (IUPAC), forward and reverse, in the order in which ties are decided.
FORWARD_PRIMERS = [
    ("1100F", "YAACGAGCGCAACCC"),
    ("27F", "AGAGTTTGATCMTGGCTCAG"),
    ("799F(3)", "AACMGGATTAGATACCCKG"),
    ("341F357F", "TACGGRNGGCWGCAG"),
    ("515F518F", "YCAGCMGCCGCGGTAA"),
    ("784f", "RGGATTAGATACCC"),
    ("926f", "TAAAACTYAAAKGAATTGACGGGG"),
    ("939f", "GAATTGACGGGGGCCCGCACAAG"),
    ("969f", "ACGCGHNRAACCTTACC"),
]
REVERSE_PRIMERS = [
    ("1064RD", "CGACRRCCATGCANCACCT"),
    ("1100RD", "GGGTTGCGCTCGTTG"),
    ("1193RD", "ACGTCATCCCCACCTTCC"),
    ("1391RD", "CGGTGTGTACAAGGCCCGGGAACG"),
    ("1406RD", "ACGGGCRGTGWGTRCAA"),
    ("1492RD", "TACGGYTACCTTGTTAYGACTT"),
    ("336R", "ACTGCTGCSYCCCGTAG"),
    ("388R", "GTGCTGCCTCCCGTAGGAGT"),
    ("503RD", "CCGCGGCTGCTGGCAC"),
    ("518R(2)", "CGTATTACCGCGGCTGCTGG"),
    ("534RD", "ATTACCGCGGCTGCTGG"),
    ("806RD", "CTACNVGGGTWTCTAAT"),
    ("926R1D", "CCGYCAATTYMTTTRAGT"),
]
FULL_LENGTH_PRIMERS = {"27F": "AGRGTTYGATYMTGGCTCAG", "1492R": "RGYTACCTTGTTACGACTT"}
#: The V3-V4 region's primers and the lengths of a region that is kept.
REGION_PRIMERS, REGION_LENGTHS = ("CCTACGGGNGGCWGCAG", "GACTACHVGGGTATCTAATCC"), (300, 500)

# IUPAC letters as sets of the bits A 1, C 2, G 4, T 8, and their complements.
BASES = "ACGT"
IUPAC = {"A": 1, "C": 2, "G": 4, "T": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}
COMPLEMENT = ("ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn")

READS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("read_idx", T.LongType()),
        T.StructField("header", T.StringType()),
        T.StructField("seq", T.StringType()),
        T.StructField("qual", T.StringType()),
    ]
)
FASTA = T.StructType([T.StructField("file", T.StringType()), T.StructField("ord", T.LongType()), T.StructField("name", T.StringType()), T.StructField("seq", T.StringType())])
FEATURES = T.StructType([T.StructField("feature_id", T.StringType()), T.StructField("sample_id", T.StringType()), T.StructField("count", T.LongType())])
