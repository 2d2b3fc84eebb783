"""What code a step runs: the closure of everything that it reaches, told by content.

From a function the closure follows the globals it reads, the attributes it takes from modules,
what it imports, its defaults, bound values and decorators, and the bases and members of classes,
until nothing new turns up. Code is told by its instructions, names and constants, so layout
and comments change nothing. Python's own modules and installed packages count by their
version; the library itself is followed like any other code, and `library_digest` covers the
files of it that nothing reaches by name.

What cannot be told from its content, such as an open connection, is refused with ValueError.
"""

from __future__ import annotations

import dis
import functools
import hashlib
import importlib.metadata
import importlib.resources
import importlib.util
import inspect
import re
import sys
import types
from collections import Counter, deque

import pyspark
from pyspark.sql import types as T

from factline.functions.canonical import canonical, digest

OWN = __name__.split(".")[0]
#: Members of classes that say nothing about what they do.
_PLUMBING = {"__dict__", "__weakref__", "__module__", "__doc__", "__firstlineno__", "__static_attributes__", "__abstractmethods__",
             "_abc_impl", "__annotate__", "__annotate_func__", "__annotations_cache__", "__dataclass_params__", "__match_args__"}
_BUILT_IN = (types.BuiltinFunctionType, types.WrapperDescriptorType, types.MethodDescriptorType, types.MethodWrapperType,
             types.ClassMethodDescriptorType, types.GetSetDescriptorType, types.MemberDescriptorType)


def code_digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


@functools.lru_cache(maxsize=1)
def library_digest() -> str:
    """A digest of the library's source files, also where it is imported from an archive."""

    def walk(folder, at):
        for entry in sorted(folder.iterdir(), key=lambda e: e.name):
            if entry.is_dir():
                yield from walk(entry, f"{at}{entry.name}/")
            elif entry.name.endswith(".py"):
                yield [at + entry.name, hashlib.sha256(entry.read_bytes()).hexdigest()]

    return digest(list(walk(importlib.resources.files(OWN), "")))


@functools.lru_cache(maxsize=None)
def settled(name: str) -> str | None:
    """The version that stands for a module's content; None for code that is followed."""
    top = name.split(".")[0]
    if top in sys.stdlib_module_names and top != "__main__":
        return "python " + sys.version.split()[0]
    if top == "pyspark":
        return "pyspark " + pyspark.__version__
    module = sys.modules.get(top)
    where = getattr(module, "__file__", None) or next(iter(getattr(module, "__path__", [])), "")
    if top == OWN or not re.search(r"[/\\](site|dist)-packages[/\\]", where):
        return None
    known = importlib.metadata.packages_distributions().get(top)
    return f"{top} {importlib.metadata.version(known[0]) if known else getattr(module, '__version__', '')}"


def _names(code: types.CodeType) -> set[str]:
    return set(code.co_names).union(*[_names(c) for c in code.co_consts if isinstance(c, types.CodeType)])


def _imports(code: types.CodeType) -> set[str]:
    own = {i.argval for i in dis.get_instructions(code) if i.opname == "IMPORT_NAME"}
    return own.union(*[_imports(c) for c in code.co_consts if isinstance(c, types.CodeType)])


class _Closure:
    """Descriptions as JSON lists; functions and classes are described once and then named."""

    def __init__(self):
        self.labels: dict[int, str] = {}
        self.held: list = []  # so that no id is taken twice
        self.waiting: deque = deque()
        self.counts: Counter = Counter()
        self.within: list[int] = []

    def of(self, value) -> list:
        found, own = {}, self.describe(value)
        while self.waiting:
            label, reached = self.waiting.popleft()
            found[label] = self.class_content(reached) if isinstance(reached, type) else self.function_content(reached)
        return [own, sorted(found.items())]

    def name(self, value, kind: str, module: str) -> list:
        if id(value) not in self.labels:
            base = f"{kind} {module}.{value.__qualname__}"
            self.labels[id(value)] = f"{base} {self.counts[base]}"
            self.counts[base] += 1
            self.held.append(value)
            self.waiting.append((self.labels[id(value)], value))
        return [self.labels[id(value)]]

    def describe(self, value):
        if value is None or isinstance(value, (bool, int, float, str, bytes, complex)) and type(value).__module__ == "builtins" or value is Ellipsis:
            return repr(value)
        if isinstance(value, types.CodeType):
            return [value.co_code.hex(), value.co_exceptiontable.hex(), [value.co_argcount, value.co_posonlyargcount, value.co_kwonlyargcount, value.co_flags],
                    list(value.co_names), list(value.co_freevars), [self.describe(c) for c in value.co_consts]]
        if isinstance(value, types.FunctionType):
            if hasattr(value, "func") and hasattr(value, "evalType"):
                return ["udf", self.describe(value.func), str(value.returnType), repr(value.evalType)]
            return self.name(value, "function", value.__globals__.get("__name__", ""))
        if isinstance(value, type):
            version = settled(value.__module__)
            return ["type", f"{value.__module__}.{value.__qualname__}", version] if version else self.name(value, "class", value.__module__)
        if isinstance(value, types.ModuleType):
            return self.module(value.__name__)
        if isinstance(value, _BUILT_IN):
            return ["built-in", str(getattr(value, "__module__", "") or ""), getattr(value, "__qualname__", value.__name__)]
        if id(value) in self.within:
            return ["again", len(self.within) - self.within.index(id(value))]
        self.within.append(id(value))
        try:
            return self.compound(value)
        finally:
            self.within.pop()

    def compound(self, value):
        if isinstance(value, (list, tuple)):
            return [type(value).__name__, *[self.describe(x) for x in value]]
        if isinstance(value, (set, frozenset)):
            return ["set", *sorted(canonical(self.describe(x)) for x in value)]
        if isinstance(value, (dict, types.MappingProxyType)):
            return ["dict", *sorted(canonical([self.describe(k), self.describe(v)]) for k, v in value.items())]
        if isinstance(value, types.MethodType):
            return ["method", self.describe(value.__func__), self.describe(value.__self__)]
        if isinstance(value, functools.partial):
            return ["partial", *[self.describe(x) for x in (value.func, value.args, value.keywords)]]
        if isinstance(value, (staticmethod, classmethod)):
            return [type(value).__name__, self.describe(value.__func__)]
        if isinstance(value, property):
            return ["property", *[self.describe(x) for x in (value.fget, value.fset, value.fdel)]]
        if isinstance(value, functools.cached_property):
            return ["property", self.describe(value.func)]
        if isinstance(value, T.DataType):
            return ["schema", value.json()]
        if isinstance(value, re.Pattern):
            return ["pattern", value.pattern if isinstance(value.pattern, str) else repr(value.pattern), value.flags]
        if isinstance(value, (types.GenericAlias, types.UnionType)) or type(value).__module__ == "typing":
            return ["annotation", repr(value)]
        if isinstance(value, types.SimpleNamespace) or settled(type(value).__module__) is None:
            return self.instance(value)
        if isinstance(inspect.getattr_static(value, "__wrapped__", None), types.FunctionType):  # such as a cached function
            return ["wrapped", self.describe(type(value)), self.describe(value.__wrapped__)]
        return self.reduced(value)

    def instance(self, value):
        if not hasattr(value, "__dict__") and not hasattr(type(value), "__slots__"):
            return self.reduced(value)
        slots = {n: getattr(value, n) for c in type(value).__mro__ for n in getattr(c, "__slots__", ()) if hasattr(value, n)}
        return ["instance", self.describe(type(value)), self.describe({**slots, **getattr(value, "__dict__", {})})]

    def reduced(self, value):
        """An object of an installed package, by what would rebuild it."""
        kind = f"{type(value).__module__}.{type(value).__qualname__}"
        home = vars(sys.modules.get(type(value).__module__, types))
        named = sorted(n for n, v in home.items() if v is value)
        if named:  # a marker that the package itself names, such as one for a missing default
            return ["constant", kind, named[0], settled(type(value).__module__)]
        try:
            parts = value.__reduce_ex__(4)
        except Exception as error:
            raise ValueError(f"cannot be identified: {kind}") from error
        if isinstance(parts, str):
            return ["constant", kind, parts]
        items = [list(x) if i > 2 and x is not None else x for i, x in enumerate(parts)]
        if items[1:] in ([(type(value),)], [(type(value),), None, None, None], [(type(value),), None]):
            raise ValueError(f"cannot be identified: {kind}")
        return ["object", kind, settled(type(value).__module__), *[self.describe(x) for x in items]]

    def module(self, name: str):
        """A module as a whole: its version, or its source."""
        version = settled(name)
        if version:
            return ["module", name, version]
        try:
            source = inspect.getsource(sys.modules[name]) if name in sys.modules else importlib.util.find_spec(name).loader.get_source(name)
        except Exception as error:
            raise ValueError(f"cannot be identified: module {name}") from error
        return ["module", name, code_digest(source or "")]

    def taken(self, module: types.ModuleType, names: set[str]) -> list:
        """What code takes from a module: the attributes that it names, and those of submodules it goes through."""
        version = settled(module.__name__)
        if version:
            return ["module", module.__name__, version]
        reached = []
        for attribute in sorted(names & vars(module).keys()):
            value = vars(module)[attribute]
            if isinstance(value, types.ModuleType):
                same = value.__name__ == module.__name__ or module.__name__.startswith(value.__name__ + ".")
                reached.append([attribute, [value.__name__] if same else self.taken(value, names)])
            else:
                reached.append([attribute, self.describe(value)])
        return ["module", module.__name__, reached]

    def function_content(self, function: types.FunctionType) -> list:
        code, space = function.__code__, function.__globals__
        bound = [self.describe(c.cell_contents) if _filled(c) else None for c in function.__closure__ or ()]
        bound += [self.describe(function.__defaults__), self.describe(function.__kwdefaults__)]
        version = settled(space.get("__name__", ""))
        if version:  # a decorator of an installed package may still hold followed code
            return [version, bound]
        names = _names(code)
        read = []
        for name in sorted(names & space.keys()):
            value = space[name]
            read.append([name, self.taken(value, names) if isinstance(value, types.ModuleType) else self.describe(value)])
        package = space.get("__package__") or ""
        for name in sorted(_imports(code)):
            for full in (name, f"{package}.{name}" if name else package):
                if full in sys.modules:
                    read.append([full, self.taken(sys.modules[full], names)])
                    break
            else:
                read.append([name, self.module(name)])
        extra = {k: v for k, v in vars(function).items() if k != "__wrapped__"}
        return [self.describe(code), bound, read, self.describe(extra)]

    def class_content(self, kind: type) -> list:
        members = [[n, self.describe(v)] for n, v in sorted(vars(kind).items()) if n not in _PLUMBING]
        return [[self.describe(base) for base in kind.__bases__], self.describe(type(kind)), members]


def _filled(cell: types.CellType) -> bool:
    try:
        cell.cell_contents
    except ValueError:
        return False
    return True


def identity(value) -> list:
    """What a value is, with all the code it reaches, as JSON lists and texts."""
    return _Closure().of(value)
