"""Test oracle: the code graph of one file, computed by walking it once, statement by statement.

It shares nothing with the package: names live in plain dictionaries that change while walking.
"""

from __future__ import annotations

import ast
import json


class Env:
    """Names of one lexical scope while its body runs."""

    def __init__(self, outer, params, body):
        self.outer, self.seen = outer, {}
        self.declared = {"local": set(params), "global": set(), "nonlocal": set()}
        self.functions = {}
        todo = list(body)
        while todo:
            node = todo.pop(0)
            if isinstance(node, ast.Lambda):
                continue
            if isinstance(node, (ast.Global, ast.Nonlocal)):
                self.declared[type(node).__name__.lower()].update(node.names)
            elif isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                self.declared["local"].add(node.name)
                if not isinstance(node, ast.ClassDef):
                    self.functions[node.name] = node
            elif isinstance(node, ast.Name) and not isinstance(node.ctx, ast.Load):
                self.declared["local"].add(node.id)
            elif isinstance(node, ast.alias) and node.name != "*":
                self.declared["local"].add((node.asname or node.name).split(".")[0])
            else:
                todo[:0] = list(ast.iter_child_nodes(node))
        self.local = self.declared["local"] - self.declared["global"] - self.declared["nonlocal"]

    def chain(self):
        env = self
        while env:
            yield env
            env = env.outer

    def define(self, name, node):
        holder = self
        if name in self.declared["global"]:
            *_, holder = self.chain()
        elif name in self.declared["nonlocal"]:
            _, *around = self.chain()
            holder = next((e for e in around if name in e.seen or name in e.local), self)
        holder.seen[name] = node

    def lookup(self, name):
        envs = list(self.chain())
        for depth, env in enumerate(envs):
            if name in env.declared["global"]:
                return envs[-1].seen.get(name)
            if name in env.declared["nonlocal"]:
                return next((e.seen[name] for e in envs[depth + 1:] if name in e.seen), None)
            if name in env.seen or name in env.local:
                return env.seen.get(name)
        return None

    def function(self, name):
        for env in self.chain():
            if name in env.functions or name in env.local:
                return env.functions.get(name)
        return None


class Walk:
    def __init__(self, source):
        self.path, self.types, self.edges = {}, {}, set()
        tree = ast.parse(source)
        self.name_tree(tree, "root")
        self.blocks(tree)
        self.body(tree.body, Env(None, (), tree.body))

    def edge(self, kind, source, target, **properties):
        if source is not target:
            text = json.dumps(properties, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            ends = [n if isinstance(n, str) else self.path[id(n)] for n in (source, target)]
            self.edges.add((kind, *ends, text))

    def name_tree(self, node, path):
        self.path.setdefault(id(node), path)
        self.types[path] = type(node).__name__
        for field in node._fields:
            value = getattr(node, field, None)
            single = not isinstance(value, list)
            for i, child in enumerate([value] if single else value):
                if isinstance(child, ast.AST):
                    here = f"{path}.{field}" if single else f"{path}.{field}[{i}]"
                    self.name_tree(child, here)
                    self.edge("AST", path, here, field=field, **({} if single else {"index": i}))

    # -- control flow
    def blocks(self, tree):
        for node in ast.walk(tree):
            if isinstance(node, (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
                self.wire(node.body, None)

    def wire(self, block, after):
        for stmt, follow in zip(block, [*block[1:], after]):
            kind = type(stmt).__name__
            inner = follow
            if kind in ("Return", "Raise", "Break", "Continue"):
                continue
            if kind == "If":
                labels = {"branch_true": stmt.body, "branch_false": stmt.orelse}
            elif kind in ("For", "AsyncFor", "While"):
                labels = {"loop_enter": stmt.body, "loop_exit": stmt.orelse}
                inner = stmt
            elif kind in ("With", "AsyncWith"):
                labels = {"with_enter": stmt.body}
            elif kind == "Try":
                labels = {"try_body": stmt.body}
                labels |= {f"except_{i}": h.body for i, h in enumerate(stmt.handlers)}
                self.wire(stmt.orelse, follow)
                self.wire(stmt.finalbody, follow)
            else:
                labels = {"next": []}
            for label, target in labels.items():
                goal = target[0] if target else follow
                if goal is not None:
                    self.edge("CFG", stmt, goal, label=label)
                self.wire(target, follow if label == "loop_exit" else inner)

    # -- names
    def read(self, name, node, env):
        found = env.lookup(name)
        if found is not None:
            self.edge("DFG", found, node, variable=name)

    def body(self, stmts, env):
        for stmt in stmts:
            getattr(self, "do_" + type(stmt).__name__, self.do_other)(stmt, env)

    def do_other(self, stmt, env):
        for child in ast.iter_child_nodes(stmt):
            self.body([child], env) if isinstance(child, ast.stmt) else self.value(child, env)

    def do_FunctionDef(self, stmt, env):
        a = stmt.args
        for part in [*stmt.decorator_list, *a.defaults, *a.kw_defaults, stmt.returns]:
            self.value(part, env)
        env.define(stmt.name, stmt)
        params = [p for p in [*a.posonlyargs, *a.args, *a.kwonlyargs, a.vararg, a.kwarg] if p]
        inside = Env(env, [p.arg for p in params], stmt.body)
        for p in params:
            inside.define(p.arg, p)
        self.body(stmt.body, inside)

    do_AsyncFunctionDef = do_FunctionDef

    def do_ClassDef(self, stmt, env):
        for part in [*stmt.bases, *stmt.decorator_list, *(k.value for k in stmt.keywords)]:
            self.value(part, env)
        env.define(stmt.name, stmt)
        self.body(stmt.body, Env(env, (), stmt.body))

    def do_Assign(self, stmt, env):
        self.value(stmt.value, env)
        for target in stmt.targets:
            self.assign(target, env)

    def do_AnnAssign(self, stmt, env):
        self.value(stmt.annotation, env)
        self.value(stmt.value, env)
        self.assign(stmt.target, env)

    def do_AugAssign(self, stmt, env):
        if isinstance(stmt.target, ast.Name):
            self.read(stmt.target.id, stmt.target, env)
        else:
            for child in ast.iter_child_nodes(stmt.target):
                self.value(child, env)
        self.value(stmt.value, env)
        self.assign(stmt.target, env)

    def do_For(self, stmt, env):
        self.value(stmt.iter, env)
        self.assign(stmt.target, env)
        self.body(stmt.body + stmt.orelse, env)

    do_AsyncFor = do_For

    def do_While(self, stmt, env):
        self.value(stmt.test, env)
        self.body(stmt.body + stmt.orelse, env)

    do_If = do_While

    def do_With(self, stmt, env):
        for item in stmt.items:
            self.value(item.context_expr, env)
            if item.optional_vars:
                self.assign(item.optional_vars, env)
        self.body(stmt.body, env)

    do_AsyncWith = do_With

    def do_Try(self, stmt, env):
        self.body(stmt.body, env)
        for handler in stmt.handlers:
            self.value(handler.type, env)
            if handler.name:
                env.define(handler.name, handler)
            self.body(handler.body, env)
        self.body(stmt.orelse + stmt.finalbody, env)

    def do_Import(self, stmt, env):
        for item in stmt.names:
            if item.name != "*":
                env.define((item.asname or item.name).split(".")[0], item)

    do_ImportFrom = do_Import

    def value(self, node, env):
        if node is None or isinstance(node, ast.Lambda):
            return
        if isinstance(node, ast.Name):
            if isinstance(node.ctx, ast.Load):
                self.read(node.id, node, env)
        elif isinstance(node, ast.NamedExpr):
            self.value(node.value, env)
            self.assign(node.target, env)
        elif isinstance(node, ast.comprehension):
            self.value(node.iter, env)
            self.assign(node.target, env)
            for test in node.ifs:
                self.value(test, env)
        else:
            for child in ast.iter_child_nodes(node):
                self.value(child, env)
            if isinstance(node, ast.Call):
                self.call(node, env)

    def assign(self, target, env):
        if isinstance(target, ast.Name):
            env.define(target.id, target)
        elif isinstance(target, (ast.Tuple, ast.List)):
            for part in target.elts:
                self.assign(part, env)
        else:
            for child in ast.iter_child_nodes(target):
                self.value(child, env)

    def call(self, node, env):
        words, head = [], node.func
        while isinstance(head, ast.Attribute):
            words.insert(0, head.attr)
            head = head.value
        words.insert(0, head.id if isinstance(head, ast.Name) else "<dynamic>")
        found = env.function(node.func.id) if isinstance(node.func, ast.Name) else None
        self.edge("CALL", node, node.func if found is None else found, callee=".".join(words),
                  resolution="unresolved" if found is None else "internal")


def graph_of(source):
    """``({path: type}, {(edge type, source path, target path, properties)})``"""
    walk = Walk(source)
    return walk.types, walk.edges
