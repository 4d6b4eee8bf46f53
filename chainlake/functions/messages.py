"""Texts of problems and alerts, and filling them with columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that readers of the control log and of the alerts know.
VOLUME_DROP = "volume muito abaixo do histórico ({rotulo}): {linhas} linhas (média: {media})"
FLAT_LABEL = "média dos últimos {dias} dias corridos"
SEASONAL_LABEL = "últimas {semanas} ocorrências do mesmo dia da semana"
STALE = "nenhuma execução em {dia} (dia útil) -- ingestão não rodou"
INCOMPLETE = "execução {execucao} (iniciada há {idade}h) sem etapa(s): {etapas}"
STUCK = (
    "execução {execucao} do Step Functions está RUNNING há {idade}h (> {margem}h) -- possível travamento"
)
BAD_ARCHIVE = "esperava exatamente 1 .csv dentro de {arquivo}, achei {achados}: {nomes}"
FILE_SUBJECT = "[{fonte}-pipeline] qualidade de dados: {arquivo}"
FILE_BODY = "Problemas encontrados em {arquivo}:\n- {problemas}"
CHECK_SUBJECT = "[{fonte}-pipeline] atualidade/linhagem: problema encontrado"
CHECK_BODY = "Problemas encontrados:\n- {problemas}"
COPY_SUBJECT = "[{fonte}-pipeline] ingestão agendada falhou"
COPY_BODY = (
    "Falha ao copiar {arquivo} do bucket de origem -- possivelmente o arquivo de hoje ainda não foi publicado "
    "no horário agendado, ou o padrão de nome mudou."
)
PROBLEM_JOINT = "\n- "

# Ours: what the reports' texts above have no words for.
SHARED_MEMBER = "{arquivos} arquivos contêm um {nome}: um sobrescreveria o outro"
CHECK_COUNT = "{checagem}: {total} problema(s), um por linha na tabela de problemas"
CHECKS_BROKEN = "checagens do lote {lote} não concluídas: {erro}"
# Ours: the job-failure alert, which the job service words itself.
JOB_SUBJECT = "[{fonte}-pipeline] job falhou"
JOB_BODY = "Job {job} run {run} terminou em {estado}"


def filled(template: str, **values: Column | str | int) -> Column:
    """`template` with each {slot} replaced by a value, as a text column."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = []
    for i, part in enumerate(parts):
        value = values[part] if i % 2 else part
        pieces.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*pieces)


def joined(problems: Column) -> Column:
    """Problems as the body of an alert lists them."""
    return F.array_join(problems, PROBLEM_JOINT)
