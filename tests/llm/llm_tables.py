"""What tests of the operators share."""

import os

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: The given tables that registered queries are tested on.
TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
