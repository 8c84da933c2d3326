"""Errors of a run: a code, what went wrong, and how to put it right; never a data value."""
from __future__ import annotations

# The HTTP status of each error code.
STATUS = {
    400: "CONFIG_NOT_FOUND CONFIG_PARSE_ERROR CONFIG_MISSING_FIELD CONFIG_INVALID CONFIG_INVALID_VALUE CONFIG_UNKNOWN_KEY CLI_INVALID_ARGUMENT DB_CONFIG_INVALID ENV_VAR_MISSING",
    422: "DATA_DIR_MISSING DATA_MISSING DATA_NO_CSV DATA_AMBIGUOUS_INPUT DATA_EMPTY DATA_JSON_INVALID DATA_XLSX_INVALID DATA_COLUMN_MISSING DATA_MALFORMED_ROW PREPROCESS_COLUMN_MISSING "
    "PREPROCESSING_FAILED PREPROCESS_CONFIG_INVALID ANON_INFEASIBLE ANON_NO_QIS GENERALIZATION_FAILED SUPPRESSION_LIMIT_EXCEEDED ENCODING_FAILED LATTICE_TOO_LARGE KEY_MATERIAL_IN_OUTPUT "
    "KEY_MATERIAL_INVALID FPE_VALUE_UNSUPPORTED FPE_DOMAIN_TOO_SMALL TOKEN_SPACE_EXHAUSTED DB_NO_ROWS",
    500: "RNG_UNAVAILABLE ENCRYPTION_FAILED IO_READ_FAILED IO_WRITE_FAILED IO_PERMISSION_DENIED INTERNAL_ERROR",
    502: "DB_CONNECT_FAILED DB_READ_FAILED DB_WRITE_FAILED",
}
_CODE = {c: s for s, codes in STATUS.items() for c in codes.split()}

_HINTS = {
    "CONFIG": "Correct the configuration file; the details name the key.",
    "CLI": "Run with --help for the arguments.",
    "ENV": "Set the environment variable or give it a default with ${NAME:-default}.",
    "DATA": "Check the input files: their place, format, header and rows.",
    "PREPROCESS": "Check the technique's columns and parameters against the input.",
    "ANON": "Name at least one quasi-identifier, or coarsen its levels.",
    "GENERALIZATION": "Lower k, raise suppression_limit, or allow coarser levels.",
    "SUPPRESSION": "Raise suppression_limit, lower k, or choose a coarser node.",
    "LATTICE": "Use fewer quasi-identifiers, larger size factors, or fewer levels.",
    "KEY": "Keep keys and salts outside the output folder and unchanged between runs.",
    "FPE": "Use encryption without format, or another technique, for this column.",
    "TOKEN": "Give the tokens more digits.",
    "DB": "Check the connection, the credentials and the table or query.",
    "IO": "Check that the path exists and may be read and written.",
}


class RunError(Exception):
    """A run that cannot go on."""

    def __init__(self, code: str, message: str, details: str = ""):
        super().__init__(f"{code}: {message}" + (f" ({details})" if details else ""))
        self.code, self.message, self.details = code, message, details

    @property
    def http_status(self) -> int:
        return _CODE.get(self.code, 500)

    @property
    def suggested_fix(self) -> str:
        return _HINTS.get(self.code.partition("_")[0], "See the log for the cause.")

    def payload(self) -> dict:
        return {"status": "error", "error": {"code": self.code, "http_status": self.http_status, "message": self.message, "details": self.details, "suggested_fix": self.suggested_fix}}
