"""Records and cells of delimited text, as expressions.

A quote opens a quoted cell only where the cell begins, and closes it only where the cell ends;
two quotes inside are one. All patterns use possessive loops, which neither backtrack nor recurse,
so a line may have any number of cells and of quotes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _patterns(separator: str) -> tuple[str, str, str]:
    """(separator, inside of a quoted cell, its closing quote)."""
    if len(separator) != 1 or separator in ' "\n\r':
        raise ValueError(f"unsupported separator: {separator!r}")
    mark = f"\\x{ord(separator):02x}" if ord(separator) < 256 else separator
    end = f'" *+(?:(?={mark})|\\z)'
    return mark, f'(?:[^"]++|""|"(?! *+(?:{mark}|\\z)))*+', end


def opens(line: Column, separator: str = ",") -> Column:
    """Whether a quoted cell is still open at the end of ``line``."""
    return line.rlike(_opens(separator))


def _opens(separator: str) -> str:
    mark, inside, end = _patterns(separator)
    cell = f'(?: *+"{inside}{end}{mark}|(?! *+")[^{mark}]*+{mark})*+'
    return f'\\A{cell} *+"{inside}\\z'


def stays_open(line: Column, separator: str = ",") -> Column:
    """Whether a quoted cell is open at the end of ``line`` if one is open at its beginning."""
    mark, inside, end = _patterns(separator)
    return line.rlike(f'\\A{inside}(?:\\z|{end}{mark}{_opens(separator)[2:]})')


def split_cells(line: Column, separator: str = ",") -> Column:
    """Cells of one record, trimmed, without their quotes; a quote that nothing closes is text."""
    mark, inside, end = _patterns(separator)
    found = F.regexp_extract_all(
        F.concat(F.lit(separator), line), F.lit(f'{mark}( *+"{inside}{end}|[^{mark}]*+)'), F.lit(1)
    )

    def plain(cell: Column) -> Column:
        quoted = cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1)
        body = F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))
        return F.when(quoted, body).otherwise(cell)

    return F.transform(found, lambda c: bind(F.trim(c), plain))
