"""One key for all spellings of a document's file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File endings a stem may still carry.
EXTENSIONS = "pdf|docx?|rtf|txt|json|xlsx?|tiff?|jpe?g|png|bmp"
#: Marks that saving, copying or scanning again leaves at a name's end.
MARKS = r"copy(?:-\d{1,3})?|kopie|scan(?:ned)?(?:-\d{1,3})?|rescan|\(\d{1,3}\)"


def stem_key(stem: Column) -> Column:
    """Lower case, one hyphen for any run of blanks, hyphens and underscores, no file ending and no
    mark of a copy or scan. A bare 1-2 digit suffix counts as such a mark only behind the document's
    own number or its annex letter, so `report-12` keeps its number. Null and blank give null."""
    s = F.lower(F.trim(stem))
    s = F.regexp_replace(s, rf"(?:\.(?:{EXTENSIONS}))+$", "")
    s = F.regexp_replace(s, r"[\s_\- ]+", "-")
    s = F.regexp_replace(s, r"-*(\(\d{1,3}\))", "-$1")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    s = F.regexp_replace(s, r"^(?:copy-of-|scan-of-)+", "")
    s = F.regexp_replace(s, rf"(?:-(?:{MARKS}))+$", "")
    s = F.regexp_replace(s, rf"(\d{{3,}}|annex-[a-z])(?:-(?:{MARKS}|\d{{1,2}}))+$", "$1")
    return F.when(s != "", s)
