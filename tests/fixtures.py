"""Source texts with known graphs."""

# texts, and their nodes and AST, CFG, DFG and CALL edges

SOURCES = {
    "pair.py": ("width = 3\nheight = width * 2\narea = width * height\n", (22, 21, 2, 3, 0)),
    "short.py": ("limit = 80\n", (5, 4, 0, 0, 0)),
    "shop.py": (
        "def price(item):\n    return item.cost + 5\n\ncart = [price(apple), price(pear)]\n"
        "show(cart, sum(cart))\n", (38, 37, 2, 5, 4)),
    "shadows.py": (
        "colour = 'red'\nfirst = colour\ncolour = 'blue'\nsecond = colour\ndef paint(wall):\n"
        "    colour = wall\n    def mix(tin):\n        colour = tin.shade\n"
        "        return colour, wall\n    return mix(colour)\n", (50, 49, 7, 8, 1)),
    "counters.py": (
        "hits = 0\ndef record(n):\n    global hits\n    hits = hits + n\n    return hits\n"
        "def meter():\n    level = 10\n    def raise_it(by):\n        nonlocal level\n"
        "        level = level + by\n        return level\n    return raise_it\nrecord(2)\n", (51, 50, 9, 8, 1)),
    "scale.py": (
        "def scale(x, factor):\n    return x * factor\n\nlarge = scale(7, 3)\n"
        "huge = scale(large, large)\n", (30, 29, 2, 6, 2)),
    "constant.py": ("class Settings:\n    retries = 3\n", (6, 5, 0, 0, 0)),
    "repeats.py": (
        "def spread(low, high):\n    span = high - low\n    again = high - low\n"
        "    return span * again + span\n", (34, 33, 2, 7, 0)),
    "loop.py": (
        "total = 0\nfor price in prices:\n    if price > 9:\n        total = total + price\n"
        "    else:\n        continue\nprint(total)\n", (32, 31, 6, 4, 1)),
    "listed.py": ("names = ['ann', 'bob']\nsizes = {name: len(name) for name in names}\n", (24, 23, 1, 1, 1)),
    "package/__init__.py": ("", (1, 0, 0, 0, 0)),
    "headless.py": ("if ready\n    go()\n", (0, 0, 0, 0, 0)),
}

# Each exercises one rule that is easy to get wrong.
ODDITIES = {
    "stale_comprehension.py": "x = 0\nxs = [x for x in range(3)]\nprint(x)\n",
    "lambda.py": "a = 1\nf = lambda p, q=a: p + a + undefined(p)\nf(a)\n",
    "annotations.py": "T = int\ndef f(a: T, *b: T, c: T = T, **d: T) -> T:\n    return a, b, c, d\n",
    "class_scope.py": "class A:\n    x = 1\n    def m(self):\n        return x\n    y = x\nx = 2\n",
    "handler_name.py": (
        "def f():\n    try:\n        g()\n    except ValueError as e:\n        print(e)\n"
        "    except (KeyError, OSError):\n        raise\n    else:\n        h = 1\n    finally:\n"
        "        k = 2\n    return e, h, k\n"),
    "delete.py": "x = 1\ndel x\nprint(x)\n",
    "match.py": (
        "def pick(v):\n    w = 1\n    match v:\n        case {'a': a, **rest} if w:\n            z = a + w\n"
        "            def inner(p: w = w):\n                global g\n                q = w\n"
        "                return q\n            import os\n            print(z, os)\n"
        "        case [1, *others] | others:\n            for i in others:\n                w = i\n"
        "    return z, inner, os, a\n"),
    "except_star.py": (
        "def f():\n    a = 1\n    try:\n        b = a\n    except* ValueError as e:\n        c = b\n"
        "        def inner():\n            return c\n    else:\n        d = b\n    return c, d, e\n"),
    "last_function.py": (
        "def f():\n    return 1\nf()\nif f:\n    def f():\n        return 2\n"
        "def g():\n    f()\n    def f():\n        pass\n    k()\n    k = 1\n    k()\nimport k\nk()\n"),
    "star_target.py": "x = [1]\na, *b = x\nprint(a, b)\nobj.field = a\nobj[a] = x\n",
    "forward.py": "def f():\n    return later\nlater = 1\ndef g():\n    return later\n",
    "augmented.py": (
        "t = 0\nd = {}\nt += 1\nd[t] += (t := 5)\nd.n -= t\ndef f():\n    t += 1\n    return t\n"),
    "walrus.py": (
        "@(dec := wrap)\ndef f(a=(w := 1), *, b=w) -> w:\n    return dec, w\n"
        "class K((base := object), metaclass=(m := type)):\n    z = base\nprint(dec, w, base, m)\n"
        "while (n := read()):\n    use(n)\nelse:\n    done(n)\n"),
    "global_param.py": "def f(x, y=x):\n    global x\n    x = y\nprint(x)\nglobal q\nq = 1\nprint(q)\n",
    "nonlocal_chain.py": (
        "def a():\n    v = 1\n    def b():\n        def c():\n            nonlocal v\n            v = 2\n"
        "            return v\n        return v\n    return v\n"),
    "nonlocal_orphan.py": (
        "def a():\n    def early():\n        nonlocal n\n        n = 0\n        return n\n"
        "    nonlocal n\n    n = 1\n    def b():\n        nonlocal n\n        n = 2\n        def c():\n"
        "            nonlocal n\n            n = 3\n            return n\n        return n\n    return n\n"),
    "nonlocal_handler.py": (
        "def a():\n    def before():\n        nonlocal e\n        e = 1\n    try:\n        pass\n"
        "    except E as e:\n        pass\n    def after():\n        nonlocal e\n        e = 2\n        return e\n"
        "    return e\n"),
    "flow.py": (
        "async def f(xs):\n    async with a as b, c as (d, e):\n        for x in xs:\n            if x:\n"
        "                try:\n                    with b:\n                        continue\n"
        "                except A:\n                    pass\n                except B:\n"
        "                    y = 1\n                else:\n                    z = 1\n"
        "                finally:\n                    w = 1\n            elif d:\n                break\n"
        "        else:\n            while e:\n                e = 0\n            else:\n                v = 1\n"
        "    async for q in xs:\n        if q:\n            class Inner:\n                t = q\n"
        "                if t:\n                    t = 2\n    return b\n"),
    "unicode.py": "größe = 1\nπ = größe\nprint(größe, 'é😀\\ud800')\nобъект.метод(π)\n",
    "imports.py": "import os.path, sys as system\nfrom a import *\nfrom b import c as d, e\nprint(os, system, d, e, c)\n",
    "typing.py": "type Alias[T: int] = list[T]\ndef f[U](x: U) -> U:\n    return x\nf(Alias)\n",
    "strings.py": "name = 'n'\ntext = f'{name!r:>{name}} {[i for i in name]}'\nlong = '" + "x" * 400 + "'\n",
    "carriage.py": "a = 1\r\nb = (a,\r\n     a)\r\n",
    "generators.py": "r = {k: v for k, v in items if k for j in v}\ns = (y for x in r for y in x)\nprint(k, v, j)\n",
    "call_chain.py": "f().g(h)[0](a.b.c(), *args, **kw)\n(lambda: 0)()\n",
    "deep.py": "x = " + " + ".join(["x"] * 400) + "\n",
    "nested.py": "".join("    " * i + f"def f{i}(a):\n" for i in range(40)) + "    " * 40 + "return a\n",
}
