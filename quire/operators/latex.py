"""S7.5: a pushdown parser of formulas in LaTeX, as a fold with a stack over an array of tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Commands and environments of formulas, by the number of their arguments.
SYMBOLS = (
    "alpha", "beta", "gamma", "delta", "epsilon", "varepsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "pi", "rho", "sigma", "tau", "phi", "varphi", "chi", "psi", "omega",
    "Gamma", "Delta", "Theta", "Lambda", "Pi", "Sigma", "Phi", "Psi", "Omega", "sum", "prod", "int", "oint", "bigcup", "bigcap", "lim", "sin", "cos", "tan", "log", "ln", "exp", "max", "min",
    "times", "div", "pm", "mp", "cdot", "cdots", "ldots", "le", "leq", "ge", "geq", "ne", "neq", "approx", "equiv", "sim", "cong", "perp", "parallel", "angle", "triangle", "circ", "degree", "infty", "partial", "nabla",
    "in", "notin", "subset", "subseteq", "cup", "cap", "emptyset", "forall", "exists", "to", "rightarrow", "leftarrow", "Rightarrow", "Leftrightarrow", "because", "therefore", "mid", "quad", "qquad", "langle", "rangle", "prime",
)
ONE = ("sqrt", "bar", "hat", "vec", "tilde", "dot", "overline", "underline", "overrightarrow", "text", "mathrm", "mathbf", "mathbb", "mathcal", "boldsymbol", "operatorname")
TWO = ("frac", "dfrac", "tfrac", "binom", "dbinom", "overset", "underset", "stackrel")
ENVIRONMENTS = ("cases", "matrix", "pmatrix", "bmatrix", "vmatrix", "aligned", "array", "gathered")

#: One token each: environments with their names, delimiters with their \left or \right, commands, white space, characters.
TOKEN = r"\\begin\{array\}\{[lcr|]+\}|\\(?:begin|end)\{[A-Za-z]+\*?\}|\\(?:left|right) *(?:\\[{}|]|\\[lr]angle|[()\[\]|./<>])|\\[A-Za-z]+|\\[\s\S]|\s+|[\s\S]"


def tokens(latex: Column) -> Column:
    return F.regexp_extract_all(latex, F.lit(f"({TOKEN})"), F.lit(1))


def _kind(token: Column) -> Column:
    """What a token does: { } [ ] ^ _ & L R B E stand for themselves; f with 1 or 2 for a command with arguments; c for an atom; a space for nothing; x for an error."""
    name = F.regexp_extract(token, r"^\\([A-Za-z]+)$", 1)
    environment = F.regexp_extract(token, r"^\\(?:begin|end)\{([A-Za-z]+)\}", 1)
    return (
        F.when(token.isin("{", "}", "[", "]", "^", "_", "&"), token)
        .when(token == r"\\", "&")
        .when(environment != "", F.when(environment.isin(*ENVIRONMENTS), F.concat(F.when(token.startswith(r"\begin"), "B").otherwise("E"), environment)).otherwise("x"))
        .when(token.rlike(r"^\\left *[^A-Za-z]"), "L")
        .when(token.rlike(r"^\\right *[^A-Za-z]"), "R")
        .when(name != "", F.when(name.isin(*SYMBOLS), "c").when(name == "sqrt", "f1s").when(name.isin(*ONE), "f1").when(name.isin(*TWO), "f2").otherwise("x"))
        .when(token.rlike(r"^\\[,;:!>\s]$|^[\s~']+$"), " ")
        .when(token.rlike(r"^\\[{}|%$&#_]$"), "c")
        .when(token.rlike(r"^[#$%\\]") | (token == r"\left") | (token == r"\right"), "x")
        .otherwise("c")
    )


def parse_error(latex: Column) -> Column:
    """Null where a formula parses; else the number and text of the token at which it fails, or `end` where something is open.

    The stack holds what is open: `{`, `[`, L, B with its environment, A or Q (of a root, which may take an option) with the number of
    arguments that are to come, and S with the scripts that its base has. An argument is one atom or a group, not a command with
    arguments of its own; a base has one script of either kind; & and line ends stand in environments only. A null formula gives null.
    """
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("stack"), F.lit("00").alias("scripts"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("at"))

    def made(stack: Column, scripts: Column | str, a: Column, error: Column | None = None) -> Column:
        scripts = F.lit(scripts) if isinstance(scripts, str) else scripts
        return F.struct(stack.alias("stack"), scripts.alias("scripts"), (F.lit(None).cast("string") if error is None else error).alias("error"), (a["at"] + 1).alias("at"))

    def step(a: Column, t: Column) -> Column:
        kind, stack = t["kind"], a["stack"]
        top = F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(""))
        below = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        push = lambda s, x: F.concat(s, F.array(F.lit(x) if isinstance(x, str) else x))
        wants = top.rlike("^[AQS]")  # an argument or a script has to come
        failed = made(stack, "00", a, F.concat_ws(" ", (a["at"] + 1).cast("string"), t["text"]))

        def whole(s: Column) -> Column:
            """The state behind an atom; if it was a script, the base keeps the scripts that S says."""
            own = F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(""))
            return F.when(own.startswith("S"), made(F.slice(s, F.lit(1), F.size(s) - 1), F.substr(own, F.lit(2)), a)).otherwise(made(s, "00", a))

        def atom(s: Column) -> Column:
            """The state once an atom is read on top of the stack s: it may be an argument, and the last one of its command."""
            own = F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(""))
            rest = F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0)))
            return F.when(own == "A2", made(push(rest, "A1"), "00", a)).when(own.isin("A1", "Q1"), whole(rest)).otherwise(whole(s))

        scripted = lambda k: F.when(wants | (F.substr(a["scripts"], F.lit(k + 1), F.lit(1)) == "1"), failed).otherwise(
            made(push(stack, F.concat(F.lit("S"), F.lit("1") if k == 0 else F.substr(a["scripts"], F.lit(1), F.lit(1)), F.lit("1") if k == 1 else F.substr(a["scripts"], F.lit(2), F.lit(1)))), "00", a)
        )
        opened = lambda what: made(push(stack, what), "00", a)
        new = (
            F.when(kind == " ", made(stack, a["scripts"], a))
            .when(kind == "x", failed)
            .when(kind == "c", atom(stack))
            .when(kind == "{", opened("{"))
            .when(kind == "}", F.when(top == "{", atom(below)).otherwise(failed))
            .when(kind == "_", scripted(0))
            .when(kind == "^", scripted(1))
            .when(kind.startswith("f"), F.when(top.rlike("^[AQ]"), failed).otherwise(opened(F.when(kind == "f1s", "Q1").otherwise(F.concat(F.lit("A"), F.substr(kind, F.lit(2)))))))
            .when(kind == "[", F.when(top == "Q1", made(push(push(below, "A1"), "["), "00", a)).otherwise(atom(stack)))
            .when(kind == "]", F.when(top == "[", made(below, "00", a)).otherwise(atom(stack)))
            .when(kind == "L", F.when(top.rlike("^[AQ]"), failed).otherwise(opened("L")))
            .when(kind == "R", F.when(top == "L", atom(below)).otherwise(failed))
            .when(kind == "&", F.when(top.startswith("B"), made(stack, "00", a)).otherwise(failed))
            .when(kind.startswith("B"), F.when(top.rlike("^[AQ]"), failed).otherwise(opened(kind)))
            .otherwise(F.when(top == F.concat(F.lit("B"), F.substr(kind, F.lit(2))), atom(below)).otherwise(failed))
        )
        return F.when(a["error"].isNotNull(), a).otherwise(new)

    read = F.transform(tokens(latex), lambda t: F.struct(_kind(t).alias("kind"), t.alias("text")))
    return F.aggregate(read, start, step, lambda a: F.when(a["error"].isNotNull(), a["error"]).when(F.size(a["stack"]) > 0, "end"))


def parses(latex: Column) -> Column:
    """Whether a formula parses; null where it is null."""
    return F.when(latex.isNotNull(), parse_error(latex).isNull())
