"""The corpus queries and their DuckDB SQL."""

from promptmill.llm import decontaminate, neighbours, phrases, warc
from promptmill.llm.alignment import op13_alignment
from promptmill.llm.decontaminate import op10_decontaminate
from promptmill.llm.digest import op11_fingerprints
from promptmill.llm.mainhtml import op5_maintext
from promptmill.llm.neighbours import op4_neighbours
from promptmill.llm.ngram import op6_ngram
from promptmill.llm.personal import op8_personal
from promptmill.llm.phrases import op12_phrases
from promptmill.llm.pieces import op3_pieces
from promptmill.llm.quality import op1_quality
from promptmill.llm.simhash import op7_simhash
from promptmill.llm.tokenfiles import op9_tokenfiles
from promptmill.llm.warc import op2_warc

QUERIES = {"op1_quality": op1_quality, "op2_warc": op2_warc, "op3_pieces": op3_pieces, "op4_neighbours": op4_neighbours, "op5_maintext": op5_maintext,
           "op6_ngram": op6_ngram, "op7_simhash": op7_simhash, "op8_personal": op8_personal, "op9_tokenfiles": op9_tokenfiles,
           "op10_decontaminate": op10_decontaminate, "op11_fingerprints": op11_fingerprints, "op12_phrases": op12_phrases,
           "op13_alignment": op13_alignment}
ORACLES: dict[str, str] = {"op2_warc": warc.SQL, "op4_neighbours": neighbours.SQL, "op10_decontaminate": decontaminate.SQL,
                           "op12_phrases": phrases.SQL}
