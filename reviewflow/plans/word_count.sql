SELECT word, count(*) AS ct
FROM book
LATERAL VIEW explode(split(lower(regexp_replace(value, :dropped, '')), ' ')) tokens AS word
WHERE word <> ''
GROUP BY word
ORDER BY ct DESC, word
